"""Removal of repeated byte strings by sampled, named and merged suffixes.

The rule: a byte goes if some string of ``min_len`` bytes covers it that also
starts earlier (smaller document, or the same document at an earlier
start). The work follows a distributed difference-cover construction:

1. *Sample.* The cover is chosen by content. Of the k-byte grams inside a
   window of ``min_len`` bytes, the one with the smallest fingerprint (the
   leftmost of equals) is the window's sampled suffix. Equal windows sample
   equal offsets, which is what a difference cover has to guarantee, and about
   one position in 40 is sampled instead of two in three.
2. *Sort triples.* Neighbouring windows that share a sampled suffix form one
   run. Its row is the triple (name of the gram, name of the whole run, place).
   Rows are sorted by it; a row whose adjacent predecessor has the same
   names repeats it, so all windows of the run repeat.
3. *Recurse on names.* Only first rows whose gram has several different runs
   are open. Each is cut into blocks of nine windows; a block is named by
   the bytes that its windows share (the core) and by eight bytes on either side.
   Blocks are sorted and compared in the same way.
4. *Merge the remaining suffixes.* Blocks that share a core but not their
   sides are merged: each single window gets as its name the core and the part
   of the sides that it covers, and takes part under its own start.
5. *Compare.* Among equal windows the earliest stays; all others mark
   their bytes.

Names are pairs of 64-bit fingerprints, so they need no global ranks; the
sorted order is that of the names. Every level reads all rows that are open, and
rows that repeat inside an Arrow batch are marked before any shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.llm._arrays import PAD, RangeHash, U64, batches, eights, mix, padded, part_slices, signed, text_buffer, tidy
from orderlake.llm.cleanup import write_and_drop_shuffles
from orderlake.llm.digest import text_digest
from orderlake.llm.names import boxed, unboxed
from orderlake.operators.ranking import with_global_position
from orderlake.session import scratch_path

GRAM = 16
BLOCK = 9
#: Window starts that are handled at once; a longer document takes several rounds.
CHUNK = 1 << 18
#: Bytes of text whose runs are named at once, and of packed texts that are unpacked before rows go out.
SLICE, PACKED = 1 << 23, 1 << 20
NULL_ID = (1 << 63) - 1

# A run's place packs its sampled place, the distances from it back to the first and the last window start, and two marks:
# the gram is frequent, and the run repeats inside its batch. A block's place packs in the same way. Shuffled rows stay small so.
_RUNS = pa.schema([("gram", pa.int64()), ("name", pa.int64()), ("ord", pa.int64()), ("tie", pa.int64()), ("place", pa.int64())])
_BLOCKS = pa.schema(
    [("c1", pa.int64()), ("c2", pa.int64()), ("left", pa.int64()), ("right", pa.int64()), ("ord", pa.int64()), ("tie", pa.int64()),
     ("place", pa.int64())]
)


def _bits(shift: int, width: int) -> Column:
    return F.shiftright("place", shift).bitwiseAND((1 << width) - 1)


def _ddl(schema: pa.Schema) -> str:
    kinds = {pa.int64(): "long", pa.int32(): "int", pa.bool_(): "boolean", pa.binary(): "binary", pa.float64(): "double"}
    return ", ".join(f"`{f.name}` {kinds[f.type]}" for f in schema)


def sampled_runs(raw: np.ndarray, offs: np.ndarray, min_len: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Runs of windows with the same sampled suffix: gram and run names, row, sampled place, first and last window start.

    Places count from the start of the row. Yields a part for each chunk.
    """
    w = min_len - GRAM + 1
    lengths = np.diff(offs)
    row = 0
    rows = len(lengths)
    inner = 0
    while row < rows:
        # A chunk: as many whole rows as fit, or a part of one long row.
        first, begin = row, int(offs[row]) + inner
        if int(offs[row + 1]) - begin > CHUNK:
            end_start = begin + CHUNK - min_len  # window starts up to here
            inner += CHUNK - min_len
            byte_end = end_start + min_len - 1
        else:
            row = max(row + 1, int(np.searchsorted(offs, begin + CHUNK, side="right")) - 1)
            inner = 0
            end_start = byte_end = int(offs[row])
        n = byte_end - begin
        if n < min_len:
            continue
        buf = padded(raw[begin:byte_end])
        g = mix(eights(buf)[: n + PAD - 16])
        grams = mix(g[:n] * U64(3) + g[8 : n + 8])
        place = np.arange(n, dtype=np.int64)
        least = (grams & ~U64((1 << 20) - 1)) | place.astype(U64)
        size = 1
        m = least
        while size * 2 <= w:
            m = np.minimum(m[: len(m) - size], m[size:])
            size *= 2
        rest = w - size
        starts = n - min_len + 1
        m = np.minimum(m[:starts], m[rest : rest + starts])
        at = (m & U64((1 << 20) - 1)).astype(np.int64)
        owner = np.searchsorted(offs, begin + place[:starts], side="right") - 1
        ok = (begin + place[:starts] + min_len <= offs[owner + 1]) & (begin + place[:starts] < end_start)
        change = np.ones(starts, bool)
        change[1:] = (at[1:] != at[:-1]) | (owner[1:] != owner[:-1]) | (ok[1:] != ok[:-1])
        head = np.flatnonzero(change)
        tail = np.append(head[1:], starts) - 1
        keep = ok[head]
        head, tail = head[keep], tail[keep]
        if not len(head):
            continue
        anchor, doc = at[head], owner[head]
        content = RangeHash(g[:n])
        name = mix(content.of(head, tail + min_len - 7) + (tail - head).astype(U64) + ((anchor - head).astype(U64) << U64(32)))
        shift = begin - offs[doc]
        yield grams[anchor], name, doc, anchor + shift, head + shift, tail + shift
        assert first < rows


def _slices(parts: Iterator[pa.RecordBatch], column: str, size: int) -> Iterator[pa.RecordBatch]:
    """The batches of a task cut by the bytes of one column, so that what is worked on at once stays small."""
    for part in parts:
        yield from part_slices(part, column, size)


def first_in_batch(keys: list[np.ndarray], doc: np.ndarray, rank: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Masks of the earliest row of each key and of later rows at another place."""
    n = len(doc)
    key = np.zeros(n, U64)
    for k in keys:
        key = mix(key + k.astype(U64))
    order = np.lexsort((at, rank[doc], key))
    same = np.zeros(n, bool)
    o = order
    same[1:] = True
    for k in keys:
        same[1:] &= k[o[1:]] == k[o[:-1]]
    head = np.flatnonzero(~same)
    lead = np.repeat(o[head], np.diff(np.append(head, n)))
    again = (rank[doc[o]] == rank[doc[lead]]) & (at[o] == at[lead])
    firsts, dups = np.zeros(n, bool), np.zeros(n, bool)
    firsts[o[~same]] = True
    dups[o[same & ~again]] = True
    return firsts, dups


def _ranks(ords: np.ndarray, ties: np.ndarray) -> np.ndarray:
    """Dense order of a batch's documents; equal rows share a rank."""
    o = np.lexsort((ties, ords))
    new = np.ones(len(o), bool)
    new[1:] = (ords[o[1:]] != ords[o[:-1]]) | (ties[o[1:]] != ties[o[:-1]])
    rank = np.empty(len(o), np.int64)
    rank[o] = np.cumsum(new) - 1
    return rank


def _run_rows(min_len: int, hot: np.ndarray):
    def apply(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(parts, "text", SLICE):
            raw, offs = text_buffer(part["text"])
            found = list(sampled_runs(raw, offs, min_len))
            if not found:
                continue
            gram, name, doc, at, lo, hi = (np.concatenate(x) for x in zip(*found))
            ords, ties = part["ord"].to_numpy(zero_copy_only=False), part["tie"].to_numpy(zero_copy_only=False)
            firsts, dups = first_in_batch([gram, name], doc, _ranks(ords, ties), at)
            keep = firsts | dups
            busy = np.zeros(len(gram), bool)
            if len(hot):
                busy = hot[np.minimum(np.searchsorted(hot, gram), len(hot) - 1)] == gram
                # A frequent gram is dealt out by the names of its runs.
                gram = np.where(busy, mix(gram + name % U64(64)), gram)
            # Marked rows need no comparison: they go to any task.
            gram = np.where(dups, mix(gram + at.astype(U64)), gram)
            place = at << 26 | (at - lo) << 14 | (at - hi) << 2 | busy.astype(np.int64) << 1 | dups
            rows = {"gram": signed(gram), "name": signed(name), "ord": ords[doc], "tie": ties[doc], "place": place}
            yield from batches({k: v[keep] for k, v in rows.items()}, _RUNS)

    return tidy(apply)


def _frequent(min_len: int, share: int):
    """Grams that a batch holds in many different runs, with their counts there."""
    schema = pa.schema([("gram", pa.int64()), ("n", pa.int64()), ("total", pa.int64())])

    def apply(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(parts, "text", SLICE):
            raw, offs = text_buffer(part["text"])
            found = [(x[0], x[1]) for x in sampled_runs(raw, offs, min_len)]
            if not found:
                continue
            gram, name = (np.concatenate(x) for x in zip(*found))
            o = np.argsort(gram)
            gram, name = gram[o], name[o]
            heads = np.flatnonzero(np.append(True, gram[1:] != gram[:-1]))
            counts = np.diff(np.append(heads, len(gram)))
            big = np.flatnonzero(counts >= max(8, len(gram) // share))
            runs = np.array([len(np.unique(name[heads[i] : heads[i] + counts[i]])) for i in big], np.int64)
            big, runs = big[runs >= max(8, len(gram) // share)], runs[runs >= max(8, len(gram) // share)]
            out = {"gram": signed(np.append(gram[heads[big]], U64(0))), "n": np.append(runs, 0),
                   "total": np.append(np.zeros(len(big), np.int64), len(gram))}
            yield from batches(out, schema)

    return tidy(apply)


def _block_rows(min_len: int):
    core = min_len - BLOCK + 1

    def apply(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor()
        for part in _slices(parts, "z", PACKED):
            found = []
            ords, ties = part["ord"].to_numpy(zero_copy_only=False), part["tie"].to_numpy(zero_copy_only=False)
            open_rows = part["open"]
            for i, z in enumerate(part["z"]):
                raw = np.frombuffer(unzip.decompress(z.as_py()), np.uint8)
                runs = open_rows[i].values
                at, lo, hi = (runs.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(3))
                # Blocks of windows that start 9 b .. 9 b + 8 bytes before the sampled place.
                b0, b1 = (at - hi) // BLOCK, (at - lo) // BLOCK
                count = b1 - b0 + 1
                run = np.repeat(np.arange(len(at)), count)
                b = np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count) + b0[run]
                c0 = at[run] - BLOCK * b
                j0, j1 = np.maximum(c0 - hi[run], 0), np.minimum(c0 - lo[run], BLOCK - 1)
                # Only the part of the text that the runs cover is fingerprinted, a chunk at a time.
                order = np.argsort(c0, kind="stable")
                c0, j0, j1 = c0[order], j0[order], j1[order]
                k = 0
                while k < len(c0):
                    stop = max(k + 1, int(np.searchsorted(c0, c0[k] + CHUNK)))
                    base = max(0, int(c0[k]) - 8)
                    top = min(len(raw), int(c0[stop - 1]) + min_len)
                    buf = np.zeros(8 + top - base + PAD, np.uint8)
                    buf[8 : 8 + top - base] = raw[base:top]
                    e = eights(buf)
                    g = mix(e)
                    s = c0[k:stop] - base + 8
                    h1, h2 = RangeHash(g, 0), RangeHash(g, 1)
                    found.append((mix(h1.of(s, s + core - 7)), mix(h2.of(s, s + core - 7)), e[s - 8], e[s + core],
                                  j0[k:stop], j1[k:stop], np.full(stop - k, i), c0[k:stop]))
                    k = stop
            if not found:
                continue
            c1, c2, left, right, j0, j1, doc, c0 = (np.concatenate(x) for x in zip(*found))
            # Bytes that no window of the block covers don't belong to its name.
            left, right = left & _left_mask(j1), right & _right_mask(j0)
            firsts, dups = first_in_batch([c1, c2, left, right, j0, j1], doc, _ranks(ords, ties), c0)
            c1 = np.where(dups, mix(c1 + c0.astype(U64)), c1)
            rows = {"c1": signed(c1), "c2": signed(c2), "left": signed(left), "right": signed(right), "ord": ords[doc], "tie": ties[doc],
                    "place": c0 << 9 | j0 << 5 | j1 << 1 | dups}
            keep = firsts | dups
            yield from batches({k: v[keep] for k, v in rows.items()}, _BLOCKS)

    return tidy(apply)


def _left_mask(j: np.ndarray) -> np.ndarray:
    """The last j of eight bytes, the latest in the top byte."""
    table = np.array([0] + [((1 << 64) - 1) ^ ((1 << (64 - 8 * k)) - 1) for k in range(1, 9)], U64)
    return table[j]


def _right_mask(j: np.ndarray) -> np.ndarray:
    """The first 8 - j of eight bytes."""
    table = np.array([(1 << (64 - 8 * k)) - 1 for k in range(8)] + [0], U64)
    return table[j]


def _as_long(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


@tidy
def _squeeze(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("ord", pa.int64()), ("tie", pa.int64()), ("doc_id", pa.int64()), ("z", pa.binary())])
    zip_ = zstandard.ZstdCompressor(level=3)
    for part in _slices(parts, "text", SLICE):
        raw, offs = text_buffer(part["text"])
        data = raw.tobytes()
        z = [zip_.compress(data[a:b]) for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())]
        yield pa.RecordBatch.from_arrays([part["ord"], part["tie"], part["doc_id"], pa.array(z, pa.binary())], schema=schema)


def _cut(min_len: int, as_text: bool):
    kept_field = pa.field("text", pa.string()) if as_text else pa.field("kept", pa.binary())
    schema = pa.schema([("doc_id", pa.int64()), ("ord", pa.int64()), ("tie", pa.int64()), ("n_bytes", pa.int64()), kept_field,
                        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])

    def apply(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor()
        for part in _slices(parts, "z", PACKED):
            sizes, kept, spans = [], [], []
            marks = part["marks"]
            for i, z in enumerate(part["z"]):
                raw = unzip.decompress(z.as_py())
                runs = []
                if marks[i].is_valid and len(marks[i].values):
                    lo, hi = (marks[i].values.field(k).to_numpy(zero_copy_only=False) for k in range(2))
                    o = np.argsort(lo, kind="stable")
                    lo, end = lo[o], np.maximum.accumulate(hi[o] + min_len)
                    new = np.append(True, lo[1:] > end[:-1])
                    heads = np.flatnonzero(new)
                    runs = list(zip(lo[heads].tolist(), end[np.append(heads[1:], len(lo)) - 1].tolist()))
                at, pieces = 0, []
                for a, b in runs:
                    pieces.append(raw[at:a])
                    at = b
                pieces.append(raw[at:])
                sizes.append(len(raw))
                left = b"".join(p.decode("utf-8", "ignore").encode() for p in pieces) if as_text else b"".join(pieces)
                kept.append(left.decode() if as_text else left)
                spans.append([{"start": a, "end": b} for a, b in runs])
            columns = [part["doc_id"], part["ord"], part["tie"], pa.array(sizes, pa.int64()), pa.array(kept, kept_field.type)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(spans, schema.field("spans").type)], schema=schema)

    return tidy(apply)


def _stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written and read again; the shuffles of a step are gone before the next."""
    spark, schema, path = df.sparkSession, df.schema, scratch_path(df.sparkSession, name)
    write_and_drop_shuffles(df, path)
    return spark.read.schema(schema).parquet(path)


def frequent_grams(keyed: DataFrame, min_len: int, share: int = 2000) -> np.ndarray:
    """Grams of at least 1 / share of a batch's runs, at most 2 * share of them.

    They only say which rows are salted; the result doesn't depend on them.
    """
    seen = keyed.select("text").mapInArrow(_frequent(min_len, share), "gram long, n long, total long")
    counts = seen.groupBy("gram").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    rows = counts.orderBy(F.col("total").desc(), F.col("n").desc(), "gram").limit(2 * share + 1).collect()
    total = sum(r["total"] for r in rows)
    hot = [r["gram"] for r in rows if r["n"] * share >= total > 0 and r["n"] > 0]
    return np.sort(np.array(hot, np.int64).view(U64))


def _earlier(keys: list[str], cols: list[str]) -> Column:
    """Whether a sorted predecessor has the same names and another place."""
    lead = Window.partitionBy(*cols, *keys).orderBy("ord", "tie", "place")
    return F.first(F.struct("ord", "tie", "place")).over(lead) != F.struct("ord", "tie", "place")


def _marked(bit: int = 0) -> Column:
    return _bits(bit, 1) == 1


def repeated_windows(keyed: DataFrame, min_len: int) -> DataFrame:
    """Ranges (lo..hi) of starts of windows that occur earlier: ord, tie, lo, hi."""
    hot = frequent_grams(keyed, min_len)
    runs = keyed.select("ord", "tie", "text").mapInArrow(_run_rows(min_len, hot), _ddl(_RUNS))
    whole = Window.partitionBy("gram")
    runs = runs.withColumns(
        {
            "open": _marked(1) | (F.min("name").over(whole) != F.max("name").over(whole)),
            "again": _marked() | _earlier(["name"], ["gram"]),
        }
    )
    at = F.shiftright("place", 26)
    runs = _stored(
        runs.where("open OR again").select(
            "ord", "tie", at.cast("int").alias("at"), (at - _bits(14, 12)).cast("int").alias("lo"), (at - _bits(2, 12)).cast("int").alias("hi"), "again"
        ),
        "repeat-runs",
    )
    unresolved = (
        runs.where("NOT again").groupBy("ord", "tie").agg(F.collect_list(F.struct("at", "lo", "hi")).alias("open"))
    )
    packed = keyed.mapInArrow(_squeeze, "ord long, tie long, doc_id long, z binary").drop("doc_id").dropDuplicates(["ord", "tie"])
    blocks = packed.join(unresolved, ["ord", "tie"]).select("ord", "tie", "z", "open").mapInArrow(_block_rows(min_len), _ddl(_BLOCKS))
    blocks = blocks.withColumn("side", F.xxhash64("left", "right", _bits(1, 8)))
    core = Window.partitionBy("c1", "c2")
    blocks = blocks.withColumns(
        {
            "open": F.min("side").over(core) != F.max("side").over(core),
            "again": _marked() | _earlier(["side"], ["c1", "c2"]),
        }
    )
    at = F.shiftright("place", 9)
    blocks = _stored(
        blocks.where("open OR again").select(
            "c1", "c2", "left", "right", "ord", "tie", at.cast("int").alias("at"), _bits(5, 4).cast("int").alias("lo"), _bits(1, 4).cast("int").alias("hi"), "again"
        ),
        "repeat-blocks",
    )
    # Single windows: j bytes of the left side, the core, 8 - j bytes of the right one.
    left = [_as_long(int(_left_mask(np.array([j]))[0])) for j in range(BLOCK)]
    right = [_as_long(int(_right_mask(np.array([j]))[0])) for j in range(BLOCK)]
    pick = lambda table: F.element_at(F.array(*[F.lit(x).cast("long") for x in table]), F.col("j") + 1)
    single = (
        blocks.where("NOT again")
        .withColumn("j", F.explode(F.sequence("lo", "hi")))
        .select("c1", "c2", "j", F.col("left").bitwiseAND(pick(left)).alias("left"), F.col("right").bitwiseAND(pick(right)).alias("right"),
                "ord", "tie", (F.col("at") - F.col("j")).alias("at"))
    )
    name = ["c1", "c2", "j", "left", "right"]
    earliest = single.groupBy(*name).agg(F.min(F.struct("ord", "tie", "at")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    later = single.join(earliest.drop("n"), name).where(F.struct("ord", "tie", "at") != F.col("first"))
    return (
        runs.where("again").select("ord", "tie", "lo", "hi")
        .unionByName(blocks.where("again").select("ord", "tie", (F.col("at") - F.col("hi")).alias("lo"), (F.col("at") - F.col("lo")).alias("hi")))
        .unionByName(later.select("ord", "tie", F.col("at").alias("lo"), F.col("at").alias("hi")))
    )


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with the columns that name a document: _ord (doc_id, with a stand-in for null), and _tie.

    Only if some doc_id has several texts, ties are told apart: _tie is then the place of the
    text's digest among all digests of such ids.
    """
    text = F.coalesce("text", F.lit(""))
    named = docs.withColumn("_ord", F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)))
    halves = named.select("_ord", F.xxhash64(F.lit(1), text).alias("x"), F.xxhash64(F.lit(2), text).alias("y"))
    ends = [f(c).alias(f"{c}{f.__name__}") for c in ("x", "y") for f in (F.min, F.max)]
    several = halves.groupBy("_ord").agg(*ends).where("xmin <> xmax OR ymin <> ymax").select("_ord")
    if several.isEmpty():
        return named.withColumn("_tie", F.lit(0).cast("long"))
    digests = named.select("_ord", text_digest().alias("_digest")).join(several, "_ord").distinct()
    placed = _stored(with_global_position(digests, [F.col("_ord"), F.col("_digest")], "_tie").select("_ord", "_digest", "_tie"), "repeat-ties")
    joined = named.withColumn("_digest", text_digest()).join(placed, ["_ord", "_digest"], "left")
    return joined.withColumn("_tie", F.coalesce("_tie", F.lit(0)).cast("long")).drop("_digest")


def remove_repeats(docs: DataFrame, min_len: int = 100) -> DataFrame:
    """Documents without the bytes that repeat earlier text.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. Returns
    per input row ``doc_id``, ``n_bytes``, ``kept`` (the remaining UTF-8 bytes,
    which may begin or end inside a character) and ``spans`` (maximal removed
    byte ranges, end exclusive).

    A null text counts as empty. Documents of fewer than ``min_len`` bytes
    lose nothing. A null doc_id comes after all others. Rows with the same
    doc_id and text are one document: each gets its result. Of different
    texts with the same doc_id the one with the smaller CRC-32 is earlier, then
    the one with the smaller MD5. Empty tables give an empty result. Texts of any length are read in chunks.
    """
    return _removed(_keyed(docs.select("doc_id", "text")), min_len, as_text=False).drop("ord", "tie")


def _removed(docs: DataFrame, min_len: int, as_text: bool) -> DataFrame:
    if not GRAM + BLOCK < min_len <= 4096:
        raise ValueError("min_len must lie between 26 and 4096")
    keyed = docs.select(
        F.col("_ord").alias("ord"),
        F.col("_tie").alias("tie"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    marks = repeated_windows(keyed, min_len).groupBy("ord", "tie").agg(F.collect_list(F.struct("lo", "hi")).alias("marks"))
    packed = keyed.mapInArrow(_squeeze, "ord long, tie long, doc_id long, z binary")
    kept = "text string" if as_text else "kept binary"
    return packed.join(marks, ["ord", "tie"], "left").select("doc_id", "ord", "tie", "z", "marks").mapInArrow(
        _cut(min_len, as_text), f"doc_id long, ord long, tie long, n_bytes long, {kept}, spans array<struct<start: long, end: long>>"
    )


def without_repeats(docs: DataFrame, min_len: int = 100) -> DataFrame:
    """``docs`` with the remaining whole characters as ``text``; all rows and columns are kept.

    ``n_chars``, if there is such a column, becomes the length of the new text. Null texts become
    empty ones. Other columns may have any names.
    """
    keyed = _keyed(boxed(docs, "doc_id", "text"))
    kept = _removed(keyed.select("doc_id", "text", "_ord", "_tie"), min_len, as_text=True).select(
        F.col("ord").alias("_ord"), F.col("tie").alias("_tie"), F.col("text").alias("_text")
    )
    joined = keyed.select("_row", "_ord", "_tie").join(kept.dropDuplicates(["_ord", "_tie"]), ["_ord", "_tie"])
    fresh = {"text": F.col("_text")} | ({"n_chars": F.length("_text").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {})
    return unboxed(joined, docs.columns, fresh)
