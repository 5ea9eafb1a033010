"""WARC archives: a writer with revisit records and a reader that salvages damaged files.

Records are gzip members of their own. The reader checks each record (member checksum, header,
length, payload digest). Where a check fails it searches on for the next member, or in
uncompressed archives the next version line, that begins a whole record; the bytes
between are quarantined and reported as gaps.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.session import scratch_path

#: Bytes of a block of members, and blocks of an archive file: it holds about ARCHIVE_BLOCKS * BLOCK bytes, and one large record more at most.
BLOCK, ARCHIVE_BLOCKS = 1 << 20, 64
_MAGIC = b"\x1f\x8b\x08"
_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
_RECORD_DDL = "path string, offset long, page_id long, record_type string, refers_to long, payload_digest string, payload_bytes long, uri string, payload binary"
_GAP_DDL = "path string, start long, end long, reason string"


def record(page_id: int | None, uri: str | None, payload: bytes, digest: str, length: int, refers_to: int | None) -> bytes:
    """One record; a revisit has no block and names the record with its payload."""
    name = "" if page_id is None else str(page_id)
    head = [
        b"WARC/1.1",
        b"WARC-Type: " + (b"response" if refers_to is None else b"revisit"),
        b"WARC-Record-ID: <urn:page:" + name.encode() + b">",
        b"WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", uri or "").encode("utf-8"),
        b"WARC-Payload-Digest: sha1:" + digest.encode(),
        b"X-Payload-Length: " + str(length).encode(),
    ]
    if refers_to is not None:
        head += [b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", b"WARC-Refers-To: <urn:page:" + str(refers_to).encode() + b">"]
        payload = b""
    head.append(b"Content-Length: " + str(len(payload)).encode())
    return b"\r\n".join(head) + b"\r\n\r\n" + payload + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """A gzip member whose last byte is 0: an empty member follows where the length's top byte isn't."""
    out = b""
    for part in (data, b""):
        z = zlib.compressobj(1, zlib.DEFLATED, 31)
        out += z.compress(part) + z.flush()
        if out.endswith(b"\0"):
            return out
    return out


def parse(data: bytes, at: int = 0) -> tuple[dict, int]:
    """The record at a place and the place behind it; ValueError says what is wrong.

    Headers may have any length. Where one can't be read, the error has a second argument: no record
    whose version line begins in front of that place is whole, for its header has the same last lines.
    """
    version = _VERSION.match(data, at)
    if not version:
        raise ValueError("no version line")
    fields, start = {}, version.end()
    while (end := data.find(b"\r\n", start)) != start:
        if end < 0:
            raise ValueError("header has no end", len(data))
        key, colon, value = data[start:end].partition(b":")
        if not colon:
            raise ValueError("bad header line", start)
        fields[key.strip().lower()] = value.strip().decode("utf-8", "replace")
        start = end + 2
    start += 2
    length = fields.get(b"content-length", "")
    if not length.isdigit():
        raise ValueError("bad content length", start)
    stop = start + int(length)
    if data[stop : stop + 4] != b"\r\n\r\n":
        raise ValueError("record is cut or its length is wrong", start)
    payload = data[start:stop]
    kind = fields.get(b"warc-type", "")
    digest = fields.get(b"warc-payload-digest", "").removeprefix("sha1:")
    if kind != "revisit" and digest and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError("payload digest differs")

    def page(key: bytes) -> int | None:
        m = re.fullmatch(r"<urn:page:(-?\d+)>", fields.get(key, ""))
        return int(m[1]) if m else None

    full = fields.get(b"x-payload-length", "")
    return {
        "page_id": page(b"warc-record-id"), "record_type": kind, "refers_to": page(b"warc-refers-to"), "payload_digest": digest,
        "payload_bytes": int(full) if full.isdigit() else len(payload), "uri": fields.get(b"warc-target-uri", ""), "payload": payload,
    }, stop + 4


def _inside(body: bytes) -> tuple[list[dict], list[tuple[int, int, str]]]:
    """Whole records of a member's body, and its other byte ranges with the reason."""
    found, lost = [], []
    at, bad, reason, dead = 0, None, "", 0
    while at < len(body):
        try:
            fields, after = parse(body, at)
        except ValueError as e:
            if bad is None:
                bad, reason = at, e.args[0]
            if len(e.args) > 1:
                dead = max(dead, e.args[1])
            at = body.find(b"WARC/1.", max(at + 1, dead))
            at = len(body) if at < 0 else at
            continue
        if bad is not None:
            lost.append((bad, at, reason))
            bad = None
        found.append(fields)
        at = after
    if bad is not None:
        lost.append((bad, len(body), reason))
    return found, lost


def salvage(data: bytes) -> Iterator[tuple[str, int, object]]:
    """("record", offset, fields) and ("gap", start, (end, reason)) of an archive, in order.

    Offsets count in the file. Every byte belongs to a record or a gap, but for
    empty members and blank lines between records. A member may hold several records: those around a bad one, and whole
    ones in front of the place where a member breaks off, are kept, and its gap names the bytes of its body.
    """
    view = memoryview(data)
    at, bad, reason, dead = 0, None, "", 0
    while at < len(data):
        found: list[dict] = []
        lost: list[tuple[int, int, str]] = []
        try:
            if data.startswith(_MAGIC, at):
                # One member at a time: feed slices until it ends.
                z = zlib.decompressobj(31)
                pieces, pos, broken = [], at, ""
                try:
                    while not z.eof and pos < len(data):
                        pieces.append(z.decompress(view[pos : pos + (1 << 16)]))
                        pos += 1 << 16
                except zlib.error as e:
                    broken = f"bad member: {e}"
                if not z.eof:
                    broken = broken or "member is cut"
                found, lost = _inside(b"".join(pieces))
                if broken:
                    raise ValueError(broken)
                if lost and not found:
                    raise ValueError(lost[0][2])
                nxt = min(pos, len(data)) - len(z.unused_data)
            elif data.startswith(b"WARC/", at):
                fields, nxt = parse(data, at)
                found = [fields]
            elif data[at : at + 2] == b"\r\n" and bad is None:
                at += 2
                continue
            else:
                raise ValueError("neither a member nor a version line")
        except ValueError as e:
            if found:
                # Records in front of the break of a member that is itself lost.
                if bad is not None:
                    yield "gap", bad, (at, reason)
                    bad = None
                for fields in found:
                    yield "record", at, fields
            if bad is None:
                bad, reason = at, e.args[0]
            # Places in the body of a member don't count in the file.
            if len(e.args) > 1 and not data.startswith(_MAGIC, at):
                dead = max(dead, e.args[1])
            places = [x for x in (data.find(_MAGIC, at + 1), data.find(b"WARC/1.", max(at + 1, dead))) if x >= 0]
            at = min(places, default=len(data))
            continue
        if bad is not None:
            yield "gap", bad, (at, reason)
            bad = None
        for fields in found:
            yield "record", at, fields
        for a, b, why in lost:
            yield "gap", at, (nxt, f"bytes {a} to {b} of the member: {why}")
        at = nxt
    if bad is not None:
        yield "gap", bad, (len(data), reason)


def write_warc(pages: DataFrame, path: str, min_revisit: int = 1000) -> None:
    """Write a record per row of pages (page_id, url, html) to archives under ``path``.

    Payload is the html in UTF-8. Of records with equal payloads (by SHA-1 and length) of at least ``min_revisit`` bytes the one
    with the largest page_id is the response and others revisit it; all else is a response. Null html and
    urls count as empty. Rows with that largest page_id are all responses; rows with a null page_id are responses and not referred
    to. Other columns are ignored; an empty table leaves no records. Files end after about 64 MB; a record is never cut, so one
    that is larger makes a larger file.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumns({"digest": F.sha1("payload"), "n": F.octet_length("payload").cast("long")})
    kept = (
        rows.where(F.col("n") >= min_revisit).groupBy("digest", "n")
        .agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("rows")).where("rows > 1").drop("rows")
    )
    linked = rows.join(kept, ["digest", "n"], "left").withColumn(
        "refers_to", F.when(F.col("page_id").isNotNull() & (F.col("page_id") != F.col("first")), F.col("first"))
    )
    # Revisits have no block; their payload doesn't travel further.
    linked = linked.withColumn("payload", F.when(F.col("refers_to").isNull(), F.col("payload")).otherwise(F.lit(b"")))

    blocks = linked.select("page_id", "url", "payload", "digest", "n", "refers_to").mapInArrow(_blocks(BLOCK), "block binary")
    writer = blocks.select(F.col("block").cast("string").alias("value")).write
    writer.option("lineSep", "\0").option("maxRecordsPerFile", ARCHIVE_BLOCKS).text(path)


def _blocks(size: int):
    """Members as rows of about ``size`` bytes, so that a file's bound on rows is one on bytes.

    A row of several times that size is followed by as many rows of an empty member each. Rows lack their last byte, which is the
    text sink's line separator.
    """

    def apply(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty = member(b"")[:-1]

        def rows(block: bytes) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([block[:-1], *[empty] * (len(block) // size)], pa.binary())], names=["block"])

        held, total = [], 0
        for part in parts:
            columns = [part[c] for c in ("page_id", "url", "payload", "digest", "n", "refers_to")]
            for i in range(part.num_rows):
                held.append(member(record(*(c[i].as_py() for c in columns))))
                total += len(held[-1])
                if total >= size:
                    yield rows(b"".join(held))
                    held, total = [], 0
        if held:
            yield rows(b"".join(held))

    return apply


def _read(spark: SparkSession, path: str, wanted: str, ddl: str) -> DataFrame:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in ddl.split(", ")])

    def apply(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for i in range(part.num_rows):
                name, rows, size = part["path"][i].as_py(), [], 0
                for kind, at, x in salvage(part["content"][i].as_py()):
                    if kind != wanted:
                        continue
                    rows.append({"path": name, "offset": at, **x} if kind == "record" else {"path": name, "start": at, "end": x[0], "reason": x[1]})
                    size += len(rows[-1].get("payload", b""))
                    if size > 1 << 22 or len(rows) >= 4096:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(apply, ddl)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Whole records of all archives under ``path``: path, offset, page_id, record_type, refers_to, payload_digest, payload_bytes, uri, payload."""
    return _read(spark, path, "record", _RECORD_DDL)


def read_gaps(spark: SparkSession, path: str) -> DataFrame:
    """Quarantined byte ranges of all archives under ``path``: path, start, end (exclusive), reason of the first failure."""
    return _read(spark, path, "gap", _GAP_DDL)


def archived(pages: DataFrame) -> DataFrame:
    """Write pages to archives in the checkpoint folder and read their records back."""
    path = scratch_path(pages.sparkSession, "warc")
    write_warc(pages, path)
    return read_records(pages.sparkSession, path)
