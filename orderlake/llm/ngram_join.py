"""Similarity join of documents on sets of word shingles.

Two documents link when the Jaccard similarity of their shingle sets reaches a
threshold. Every pair that can reach it shares one of the first
``n - ceil(t * n) + 1`` shingles of both sets in any common order; the order used
puts shingles of heavily filled hash counters last, so what many documents share
hardly ever joins. Documents that share such a shingle meet in a tile:

1. Documents with equal sets become one class before anything is joined.
2. Tiles over prefix shingles and size bands: members are joined by the shortest
   spanning trees of their bitmap signatures, and the tree edges are checked exactly. This
   only shrinks later work: whole groups of near copies become one component through a
   number of edges that is linear in the group.
3. The same tiles again: members of components that are still different are compared by size, by place in the order and by signature. All
   pairs that these bounds can't exclude are checked exactly.

A signature holds the parity of the number of shingles per hash bit. The bits in which two
signatures differ are at most the shingles that only one set has, so
``(|A| + |B| - differing bits) / 2`` bounds the overlap from above. In tiles signatures are short
and fill up in long documents, so the pairs found are first compared by signatures as wide as
their sets, and only those left are checked exactly, by intersecting sorted arrays of
64-bit shingle fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.llm._arrays import U64, batches, lower_ascii, mix, release, rolling, row_slices, text_buffer, word_hashes, words_of
from orderlake.llm.components import components
from orderlake.llm.digest import text_digest
from orderlake.llm.names import boxed, unboxed
from orderlake.session import owned_scratch, scratch_path

BITS = 512
#: Hash counters that order the shingles: a fixed size, whatever the input.
COUNTERS = 1 << 17
NULL_ID = (1 << 63) - 1
#: Tile members whose spanning tree is found at once; larger tiles take several trees.
TREE = 8192
#: Members of the previous part that a tree of a larger tile begins with.
SHARED = 256


def shingle_rows(column: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle fingerprints of all texts, and the offsets of the rows.

    Shorter texts have their whole word sequence as one shingle.
    """
    raw, offs = text_buffer(column)
    raw = lower_ascii(raw)
    start, end, row = words_of(raw, offs)
    h = word_hashes(raw, start, end)
    rows = len(offs) - 1
    counts = np.bincount(row, minlength=rows)
    if len(h) >= words:
        inner = row[: len(row) - words + 1] == row[words - 1 :]
        grams, owner = rolling(h, words)[inner], row[: len(row) - words + 1][inner]
    else:
        grams, owner = np.zeros(0, U64), np.zeros(0, np.int64)
    short = np.flatnonzero((counts > 0) & (counts < words))
    if len(short):
        first = np.cumsum(counts) - counts
        whole = np.array([rolling(h[first[r] : first[r] + counts[r]], int(counts[r]))[0] for r in short], U64)
        whole = mix(whole ^ U64(0xA0761D6478BD642F)) + counts[short].astype(U64)
        grams, owner = np.append(grams, whole), np.append(owner, short)
        o = np.argsort(owner, kind="stable")
        grams, owner = grams[o], owner[o]
    return grams, np.append(0, np.cumsum(np.bincount(owner, minlength=rows)))


def _counters(words: int):
    chunk = 1 << 12

    def apply(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        total = np.zeros(COUNTERS, np.int64)
        for part in parts:
            for texts in row_slices(part["text"]):
                grams, _ = shingle_rows(texts, words)
                total += np.bincount((grams % U64(COUNTERS)).astype(np.int64), minlength=COUNTERS)
        filled = [i for i in range(COUNTERS // chunk) if total[i * chunk : (i + 1) * chunk].any()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(filled, pa.int32()), pa.array([total[i * chunk : (i + 1) * chunk].tobytes() for i in filled], pa.binary())],
            names=["slot", "counts"],
        )

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_py(), np.int64) for x in table["counts"])
        return pa.table({"slot": table["slot"][:1], "counts": pa.array([total.tobytes()], pa.binary())})

    return apply, add


def order_levels(docs: DataFrame, words: int) -> np.ndarray:
    """Level of each hash counter: about eight times the logarithm of the shingles in it, over all documents."""
    count, add = _counters(words)
    slots = docs.select("text").mapInArrow(count, "slot int, counts binary").groupBy("slot").applyInArrow(add, "slot int, counts binary")
    total = np.zeros(COUNTERS, np.int64)
    for r in slots.toLocalIterator():
        part = np.frombuffer(r["counts"], np.int64)
        total[r["slot"] * len(part) : (r["slot"] + 1) * len(part)] = part
    return np.minimum(255, 8 * np.log2(total + 1)).astype(np.uint8)


def signature(grams: np.ndarray) -> np.ndarray:
    """Parity bitmap of a set."""
    bit = (mix(grams) >> U64(55)).astype(np.int64)
    return np.packbits((np.bincount(bit, minlength=BITS) & 1).astype(np.uint8))


def wide_signature(grams: np.ndarray) -> bytes:
    """Parity bitmap of at least a bit per member; empty where the tiles' signature has as many."""
    if len(grams) <= BITS:
        return b""
    size = 1 << (len(grams) - 1).bit_length()
    bit = (mix(grams) & U64(size - 1)).astype(np.int64)
    return np.packbits((np.bincount(bit, minlength=size) & 1).astype(np.uint8)).tobytes()


def differing_bits(a: bytes, b: bytes) -> int:
    """Bits in which two wide signatures differ, the wider one folded to the narrower one's size."""
    size = min(len(a), len(b))
    u, v = (np.bitwise_xor.reduce(np.frombuffer(x, np.uint8).reshape(-1, size)) for x in (a, b))
    return int(np.bitwise_count(u ^ v).sum())


_SETS = "ord long, tie binary, n int, s1 long, s2 long, prefix array<long>, sig binary, wide binary"


def _sets(words: int, percent: int, levels: np.ndarray):
    def apply(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for part in parts:
            n, s1, s2, prefix, sig, wide = [], [], [], [], [], []
            for texts in row_slices(part["text"]):
                grams, offs = shingle_rows(texts, words)
                for a, b in zip(offs[:-1].tolist(), offs[1:].tolist()):
                    u = np.unique(grams[a:b])
                    k = len(u)
                    n.append(k)
                    if not k:
                        s1.append(0), s2.append(0), prefix.append([]), sig.append(b""), wide.append(b"")
                        continue
                    m = mix(u)
                    s1.append(int(m.sum().astype(np.int64)))
                    s2.append(int(mix(m).sum().astype(np.int64)))
                    take = k - -(-percent * k // 100) + 1
                    key = (levels[(u % U64(COUNTERS)).astype(np.int64)].astype(U64) << U64(56)) | (u >> U64(8))
                    prefix.append(u[np.argsort(key, kind="stable")[:take]].view(np.int64))
                    sig.append(signature(u).tobytes())
                    wide.append(wide_signature(u))
            yield pa.RecordBatch.from_arrays(
                [part["ord"], part["tie"], pa.array(n, pa.int32()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()),
                 pa.array(prefix, pa.list_(pa.int64())), pa.array(sig, pa.binary()), pa.array(wide, pa.binary())],
                names=["ord", "tie", "n", "s1", "s2", "prefix", "sig", "wide"],
            )

    return apply


def _groups(parts: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[dict[str, np.ndarray]]:
    """Groups of at least two rows with equal keys, from sorted batches."""
    left: pa.Table | None = None

    def arrays(t: pa.Table) -> dict[str, np.ndarray]:
        out = {}
        for name in t.column_names:
            c = t[name].combine_chunks()
            if pa.types.is_binary(c.type):
                raw, _ = text_buffer(c)
                out[name] = raw.reshape(len(c), BITS // 8).view(U64)
            else:
                out[name] = c.to_numpy(zero_copy_only=False)
        return out

    def split(x: dict[str, np.ndarray], n: int) -> np.ndarray:
        new = np.zeros(n, bool)
        new[0] = True
        for k in keys:
            new[1:] |= x[k][1:] != x[k][:-1]
        return np.append(np.flatnonzero(new), n)

    for part in parts:
        if not part.num_rows:
            continue
        t = pa.Table.from_batches([part])
        if left is not None:
            same = all(left[k][-1].as_py() == t[k][-1].as_py() for k in keys)
            t = pa.concat_tables([left, t])
            if same and all(t[k][0].as_py() == t[k][-1].as_py() for k in keys):
                left = t
                continue
        x = arrays(t)
        cuts = split(x, t.num_rows)
        for a, b in zip(cuts[:-2].tolist(), cuts[1:-1].tolist()):
            if b - a > 1:
                yield {k: v[a:b] for k, v in x.items()}
        left = t.slice(int(cuts[-2]))
    if left is not None and left.num_rows > 1:
        yield arrays(left)


def _need(n: np.ndarray | int, m: np.ndarray | int, percent: int) -> np.ndarray | int:
    """Least overlap of linked sets of these sizes."""
    return -(-percent * (n + m) // (100 + percent))


def _candidates(x: dict[str, np.ndarray], v: int, rest: np.ndarray, percent: int) -> np.ndarray:
    """Differing bits of member v and each of rest, or a large number where the bounds exclude a link."""
    n, m = x["n"][rest].astype(np.int64), int(x["n"][v])
    far = np.bitwise_count(x["sig"][rest] ^ x["sig"][v]).sum(axis=1, dtype=np.int64)
    ok = (np.minimum(n, m) * 100 >= percent * np.maximum(n, m)) & ((n + m - far) // 2 >= _need(n, np.int64(m), percent))
    return np.where(ok, far, 1 << 30)


_PAIRS = pa.schema([("x", pa.int64()), ("y", pa.int64())])


def _trees(percent: int, keys: list[str]):
    """Edges of the shortest spanning trees of a tile's signatures; members of one component are joined beforehand."""
    none = 1 << 30

    def tree(x: dict[str, np.ndarray]) -> Iterator[tuple[int, int]]:
        m = len(x["rid"])
        best = np.full(m, none)
        link = np.zeros(m, np.int64)
        rest = np.arange(1, m)
        v = 0
        while len(rest):
            d = np.where(x["comp"][rest] == x["comp"][v], -1, _candidates(x, v, rest, percent))
            nearer = d < best[rest]
            best[rest[nearer]] = d[nearer]
            link[rest[nearer]] = v
            k = int(np.argmin(best[rest]))
            v = int(rest[k])
            if 0 <= best[v] < none:
                yield int(x["rid"][link[v]]), int(x["rid"][v])
            rest = np.delete(rest, k)

    def apply(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        out: list[tuple[int, int]] = []
        for group in _groups(parts, keys):
            # Guests alone meet as home rows of their own band.
            if group["comp"].min() == group["comp"].max() or not group["home"].any():
                continue
            m = len(group["rid"])
            for at in range(0, m, TREE):
                pick = np.arange(at, min(m, at + TREE))
                if at:
                    pick = np.append(np.linspace(at - TREE, at - 1, SHARED).astype(int), pick)
                out.extend(tree({k: v[pick] for k, v in group.items()}))
            if len(out) > 1 << 16:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], schema=_PAIRS)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], schema=_PAIRS)

    return apply


def _tile_pairs(percent: int):
    """Pairs of different components that size, place and signature can't exclude.

    A tile holds the rows of its size band and guests of the next larger one.
    """

    def apply(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for x in _groups(parts, ["token", "band"]):
            if x["comp"].min() == x["comp"].max():
                continue
            n, pos, comp, rid = x["n"].astype(np.int64), x["pos"].astype(np.int64), x["comp"], x["rid"]
            home = x["home"]
            for v in np.flatnonzero(home).tolist():
                # Each pair once: later home rows, and all guests.
                rest = np.flatnonzero(~home | (np.arange(len(n)) > v))
                rest = rest[comp[rest] != comp[v]]
                need = _need(n[rest], n[v], percent)
                rest = rest[np.minimum(n[rest] - pos[rest], n[v] - pos[v]) >= need]
                if not len(rest):
                    continue
                hit = rest[_candidates(x, v, rest, percent) < 1 << 30]
                if len(hit):
                    yield from batches({"x": np.minimum(rid[hit], rid[v]), "y": np.maximum(rid[hit], rid[v])}, _PAIRS)

    return apply


def _closer(percent: int):
    """Pairs that the wide signatures can't exclude either."""

    def apply(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for part in parts:
            keep = []
            for n, m, a, b in zip(*(part[c].to_pylist() for c in ("nx", "ny", "wx", "wy"))):
                keep.append(not a or not b or (n + m - differing_bits(a, b)) // 2 >= _need(n, m, percent))
            yield pa.RecordBatch.from_arrays([part["x"], part["y"]], schema=_PAIRS).filter(pa.array(keep, pa.bool_()))

    return apply


def _check(words: int, percent: int):
    def apply(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        unzip = zstandard.ZstdDecompressor()
        known: tuple[int | None, np.ndarray] = (None, np.zeros(0, U64))

        def read(z: pa.Scalar) -> np.ndarray:
            grams, _ = shingle_rows(pa.array([unzip.decompress(z.as_py())], pa.binary()), words)
            return np.unique(grams)

        for part in parts:
            x, y = [], []
            for i, (a, b) in enumerate(zip(part["x"].to_pylist(), part["y"].to_pylist())):
                if known[0] != a:
                    known = (a, read(part["zx"][i]))
                u, v = known[1], read(part["zy"][i])
                both = len(np.intersect1d(u, v, assume_unique=True))
                if 100 * both >= percent * (len(u) + len(v) - both):
                    x.append(a)
                    y.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], schema=_PAIRS)

    return apply


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _squeeze(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    release()
    zip_ = zstandard.ZstdCompressor(level=1)
    for part in parts:
        raw, offs = text_buffer(part["text"])
        data = raw.tobytes()
        z = [zip_.compress(data[a:b]) for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())]
        yield pa.RecordBatch.from_arrays([part["ord"], part["tie"], pa.array(z, pa.binary())], names=["ord", "tie", "z"])


def _texts(keyed: DataFrame, ids: DataFrame) -> DataFrame:
    """rid and compressed text of the classes in ids (rid, ord, tie)."""
    packed = keyed.mapInArrow(_squeeze, "ord long, tie binary, z binary")
    return packed.join(ids, ["ord", "tie"]).select("rid", "z").dropDuplicates(["rid"])


def _band(n: Column, percent: int) -> Column:
    """Size band: linked sets lie in the same band or in neighbouring ones."""
    import math

    return F.floor(F.log(n.cast("double")) / F.lit(-math.log(percent / 100)) + F.lit(1e-9)).cast("int")


def shingle_links(docs: DataFrame, words: int = 3, percent: int = 90) -> tuple[DataFrame, DataFrame]:
    """Classes of equal shingle sets, and links that connect them.

    Returns ``members`` (ord, tie, n, rid: a row per distinct document, with its class) and ``links``
    (x, y: classes that are linked, enough of them to connect all that any links connect).
    """
    if not 50 <= percent <= 100:
        raise ValueError("percent must lie between 50 and 100")
    keyed = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("ord"),
        text_digest().alias("tie"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    levels = order_levels(keyed, words)
    sets = _stored(keyed.mapInArrow(_sets(words, percent, levels), _SETS).withColumn("row", F.monotonically_increasing_id()), "shingle-sets")
    # The class of equal sets is named by the stored row of its first document.
    first = sets.groupBy("s1", "s2", "n").agg(F.min(F.struct("ord", "tie", "row")).alias("f"))
    first = _stored(first.select("s1", "s2", "n", F.col("f.ord").alias("ord"), F.col("f.tie").alias("tie"), F.col("f.row").alias("rid")), "shingle-classes")
    members = (
        sets.where("n > 0").select("ord", "tie", "n", "s1", "s2")
        .join(first.select("s1", "s2", "n", "rid"), ["s1", "s2", "n"]).select("ord", "tie", "n", "rid").distinct()
        .unionByName(sets.where("n = 0").groupBy("ord", "tie", "n").agg(F.min("row").alias("rid")))
    )
    classes = sets.where("n > 0").drop("ord", "tie", "s1", "s2", "n").join(
        first.select(F.col("rid").alias("row"), "ord", "tie", "n"), "row"
    ).withColumnRenamed("row", "rid")
    classes = _stored(classes, "shingle-reps")

    def linked(pairs: DataFrame, texts: DataFrame) -> DataFrame:
        return (
            pairs.join(texts.select(F.col("rid").alias("x"), F.col("z").alias("zx")), "x")
            .join(texts.select(F.col("rid").alias("y"), F.col("z").alias("zy")), "y")
            .select("x", "y", "zx", "zy")
            .mapInArrow(_check(words, percent), "x long, y long")
        )

    def closer(pairs: DataFrame) -> DataFrame:
        side = lambda c: classes.select(F.col("rid").alias(c), F.col("n").alias(f"n{c}"), F.col("wide").alias(f"w{c}"))
        both = pairs.join(side("x"), "x").join(side("y"), "y").select("x", "y", "nx", "ny", "wx", "wy")
        return both.mapInArrow(_closer(percent), "x long, y long")

    def texts_of(pairs: DataFrame, name: str) -> DataFrame:
        ids = pairs.select(F.explode(F.array("x", "y")).alias("rid")).distinct()
        return _stored(_texts(keyed, ids.join(classes.select("rid", "ord", "tie"), "rid")), name)

    # Rows of prefix shingles that several components have; one shuffle by shingle.
    tile = Window.partitionBy("token")
    several = F.min("comp").over(tile) != F.max("comp").over(tile)

    def shared(rows: DataFrame, name: str) -> DataFrame:
        return _stored(rows.withColumn("several", several).where("several").drop("several"), name)

    def tiles(rows: DataFrame) -> DataFrame:
        """Rows by shingle and size band: each at home in its band, and a guest in the next smaller one."""
        banded = rows.withColumn("size", _band(F.col("n"), percent)).withColumn("home", F.explode(F.array(F.lit(True), F.lit(False))))
        dealt = banded.withColumn("band", F.when(F.col("home"), F.col("size")).otherwise(F.col("size") - 1))
        rows = dealt.join(classes.select("rid", "sig"), "rid").select("token", "band", "home", "rid", "comp", "n", "pos", "sig")
        return rows.repartition("token", "band").sortWithinPartitions("token", "band", F.desc("home"), "n", "rid")

    live = shared(classes.select("rid", F.col("rid").alias("comp"), "n", F.posexplode("prefix").alias("pos", "token")), "tile-rows")
    # First the tree edges of every tile, a linear number.
    edges = _stored(closer(tiles(live).mapInArrow(_trees(percent, ["token", "band"]), "x long, y long").distinct()), "tile-edges")
    found = linked(edges, texts_of(edges, "edge-texts"))
    stars = _stored(components(found.toDF("a", "b")).where("node <> root"), "stars")
    # Then all pairs of components that are still different: of pairs that the bounds can't exclude, none is left out.
    live = live.drop("comp").join(stars.withColumnRenamed("node", "rid"), "rid", "left").withColumn("comp", F.coalesce("root", "rid")).drop("root")
    live = shared(live, "tile-rows")
    pairs = _stored(closer(tiles(live).mapInArrow(_tile_pairs(percent), "x long, y long").distinct()), "tile-pairs")
    more = linked(pairs, texts_of(pairs, "tile-texts"))
    links = stars.select(F.col("node").alias("x"), F.col("root").alias("y")).unionByName(more)
    return members, links


def component_rows(docs: DataFrame, words: int = 3, percent: int = 90) -> DataFrame:
    """ord, tie, n (shingles) and root (a row number that names the component) of each distinct document.

    They are stored; the tables that the search makes are deleted with its end.
    """
    path = scratch_path(docs.sparkSession, "shingle-components")
    with owned_scratch(docs.sparkSession):
        members, links = shingle_links(docs, words, percent)
        nodes = components(links.toDF("a", "b"))
        named = members.join(nodes.withColumnRenamed("node", "rid"), "rid", "left").withColumn("root", F.coalesce("root", "rid"))
        named.select("ord", "tie", "n", "root").write.parquet(path)
    return docs.sparkSession.read.schema("ord long, tie binary, n int, root long").parquet(path)


def one_of_each(docs: DataFrame, words: int = 3, percent: int = 90) -> DataFrame:
    """The rows of docs that stay when of each component only its first document is kept.

    First is the smallest doc_id (null last), then the smallest CRC-32 of the text, then the smallest MD5. Of rows with the same doc_id and text one stays.
    All columns are kept, whatever their names. Documents without words are components of their own.
    """
    named = component_rows(docs, words, percent)
    first = named.groupBy("root").agg(F.min(F.struct("ord", "tie")).alias("f")).select(F.col("f.ord").alias("_ord"), F.col("f.tie").alias("_tie"))
    keyed = boxed(docs, F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("_ord"), text_digest().alias("_tie"))
    return unboxed(keyed.join(first, ["_ord", "_tie"]).dropDuplicates(["_ord", "_tie"]), docs.columns)


def similar_components(docs: DataFrame, words: int = 3, percent: int = 90) -> DataFrame:
    """Shingle set size and component of each document: doc_id, n_shingles, component_id.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. Words are
    the runs of bytes other than white space after lower-casing A-Z.
    Documents link when ``100 * |A and B| >= percent * |A or B|``; component_id is the smallest
    doc_id that links reach, the document's own included.

    Null and empty texts have no shingles and link with nothing. A null doc_id
    takes part, but comes last: its component_id is null if no other document is reached.
    Rows with the same doc_id and text are one document and get the same row each.
    Empty tables give an empty result. Whole texts count, of any length.
    """
    named = component_rows(docs, words, percent)
    least = named.groupBy("root").agg(F.min("ord").alias("least"))
    result = named.join(least, "root")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("ord"),
        text_digest().alias("tie"),
    )
    back = lambda c: F.when(F.col(c) != NULL_ID, F.col(c))
    return rows.join(result, ["ord", "tie"]).select("doc_id", F.col("n").cast("long").alias("n_shingles"), back("least").alias("component_id"))
