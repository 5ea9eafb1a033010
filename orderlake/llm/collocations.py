"""Collocations: phrases whose words keep company, mined with broadcast double-array tries.

1. *Words.* Words are counted per language. Those that reach the least count get dense
   numbers; the table of their fingerprints turns every text into an array of numbers, in which
   a zero stands for whatever ends a phrase (a piece's end, or words that are too rare).
2. *Candidates.* A phrase of k words can only be frequent if both its parts of k - 1 words are.
   Where two such parts lie side by side in the text, the pair of their numbers is a possible phrase. Of these only
   those stay whose occurrences, counted up to the least count in each slice of text, reach it in sum.
3. *Tries.* Candidates are numbered in order and cut into shards of bounded size. A task builds
   the double-array trie of each shard; a word number is spelled in digits of ten bits, so that a
   node's children span at most 1024 places. The driver broadcasts one trie at a time.
4. *Counts.* In each array numpy moves the states of all positions through the trie, word by word and digit by
   digit, keeping the positions that are still alive. Accepting states are bincounted in each task, and the tasks' counts are summed.
5. *Scores.* Each cut of a phrase into two parts joins with the parts' counts; arithmetic is in 38-digit decimals.

Between levels the arrays are stored with the phrase number that begins at each position;
positions that no possible longer phrase covers are dropped, so every level reads less. Words are told apart by
64-bit fingerprints of their bytes and their language.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlake.llm._arrays import U64, lower_ascii, mix, part_slices, signed, text_buffer, tidy, word_hashes
from orderlake.operators.ranking import with_global_position
from orderlake.session import scratch_path, session_conf

#: Bytes of text that are worked on at once.
SLICE = 1 << 22
#: Frequent words whose fingerprints are broadcast at once (8 bytes each).
WORDS_SHARD = 1 << 21
#: Candidates of one broadcast trie (about 30 bytes each).
SHARD = 1 << 18
#: Counts of a bincount that move together (8 bytes each).
CELLS = 512
#: Texts in a batch, bytes of a batch: an executor holds several batches for each of its tasks.
TEXTS_AT_ONCE, BATCH = 2048, 1 << 24
#: Arrays and tries are rows of some megabytes. Parquet's writer looks at its buffers after each of them, and few are read at once.
ROWS_AT_ONCE = 2
_WIDE_ROWS = {"parquet.block.size": str(1 << 24), "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1", "parquet.enable.dictionary": "false"}
DIGIT = 10
SPAN = 1 << DIGIT

# Fixed values of the rule: what ends a piece, and what ends a word.
PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
WORD_ENDS = b"\x20\x09"
NO_LANG = "und"

_IS_PIECE_END = np.zeros(256, bool)
_IS_PIECE_END[list(PIECE_ENDS)] = True
_IS_SOLID = ~_IS_PIECE_END
_IS_SOLID[list(WORD_ENDS)] = False


def split_words(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each word, and whether a piece begins with it."""
    solid = np.zeros(len(raw) + 2, bool)
    solid[1:-1] = _IS_SOLID[raw]
    # A row's end ends a word, too: the words of each row are found in a copy with a gap at its first byte.
    edge = np.flatnonzero(solid[1:] != solid[:-1])
    start, end = edge[::2], edge[1::2]
    cuts = offs[1:-1]
    cuts = np.unique(cuts[(cuts > 0) & (cuts < len(raw))])
    cuts = cuts[solid[cuts] & solid[cuts + 1]]  # inside a run
    start, end = np.sort(np.append(start, cuts)), np.sort(np.append(end, cuts))
    row = np.searchsorted(offs, start, side="right") - 1
    ends = np.flatnonzero(_IS_PIECE_END[raw])
    seen = np.searchsorted(ends, start)
    fresh = np.ones(len(start), bool)
    fresh[1:] = (seen[1:] != seen[:-1]) | (row[1:] != row[:-1])
    return start, end, row, fresh


def fingerprints(raw: np.ndarray, start: np.ndarray, end: np.ndarray, lang: np.ndarray) -> np.ndarray:
    """Of words with the fingerprint of their language."""
    return mix(word_hashes(raw, start, end) ^ lang)


def _langs(column: pa.Array) -> np.ndarray:
    raw, offs = text_buffer(column)
    return mix(word_hashes(raw, offs[:-1], offs[1:]) + U64(1))


def _taken(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The byte ranges as strings."""
    size = end - start
    ends = np.cumsum(size)
    at = np.repeat(start - ends + size, size) + np.arange(int(ends[-1]) if len(ends) else 0)
    offsets = pa.array(np.append(0, ends), pa.int32())
    return pa.StringArray.from_buffers(len(start), offsets.buffers()[1], pa.py_buffer(raw[at].tobytes()))


@tidy
def _word_counts(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of each slice with their counts, and per language the empty word with the count of all."""
    for part in parts:
        for piece in part_slices(part, "text", SLICE):
            raw, offs = text_buffer(piece["text"])
            raw = lower_ascii(raw)
            start, end, row, _ = split_words(raw, offs)
            if not len(start):
                continue
            langs = piece["lang"].combine_chunks() if isinstance(piece["lang"], pa.ChunkedArray) else piece["lang"]
            codes = langs.dictionary_encode()
            which = codes.indices.to_numpy(zero_copy_only=False)[row]
            _, first, n = np.unique(fingerprints(raw, start, end, _langs(langs)[row]), return_index=True, return_counts=True)
            total = np.bincount(which, minlength=len(codes.dictionary))
            words = pa.concat_arrays([_taken(raw, start[first], end[first]), pa.array([""] * len(total), pa.string())])
            names = codes.dictionary.take(pa.array(np.append(which[first], np.arange(len(total)))))
            yield pa.RecordBatch.from_arrays([names, words, pa.array(np.append(n, total), pa.int64())], names=["lang", "word", "n"])


@tidy
def _word_prints(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        raw, offs = text_buffer(part["word"])
        fp = fingerprints(raw, offs[:-1], offs[1:], _langs(part["lang"]))
        yield pa.RecordBatch.from_arrays([part["lang"], part["word"], part["n"], pa.array(signed(fp))], names=["lang", "word", "n", "fp"])


_ROW = pa.schema([("codes", pa.binary()), ("states", pa.binary()), ("rest", pa.binary()), ("hits", pa.binary())])
_ROW_DDL = "codes binary, states binary, rest binary, hits binary"


def _row(codes: np.ndarray | None = None, states: np.ndarray | None = None, rest: np.ndarray | None = None, hits: np.ndarray | None = None) -> pa.RecordBatch:
    cells = [pa.array([None if x is None else x.tobytes()], pa.binary()) for x in (codes, states, rest, hits)]
    return pa.RecordBatch.from_arrays(cells, schema=_ROW)


def _ints(cell: pa.Scalar, kind=np.int32) -> np.ndarray:
    return np.frombuffer(cell.as_buffer() or b"", kind)


def squeezed(codes: np.ndarray, states: np.ndarray, covered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Only the covered positions; a zero stands for each run of others."""
    keep = covered.copy()
    keep[1:] |= covered[:-1]  # the first position behind a run becomes its end
    ends = keep & ~covered
    return np.where(ends, 0, codes)[keep].astype(np.int32), np.where(ends, 0, states)[keep].astype(np.int32)


def _pairs_cover(states: np.ndarray, k: int) -> np.ndarray:
    """Positions within two k-word phrases that begin side by side: only there can a longer one lie."""
    n = len(states)
    both = np.zeros(n + 1, np.int32)
    first = np.flatnonzero((states[:-1] > 0) & (states[1:] > 0)) if n > 1 else np.zeros(0, np.int64)
    both[first] += 1
    np.subtract.at(both, np.minimum(first + k + 1, n), 1)
    return np.cumsum(both[:-1]) > 0


def _numbered(table: Broadcast, base: int, first: bool, last: bool):
    """Texts as arrays of word numbers; with several shards of fingerprints, a pass for each."""

    def look_up(prints: np.ndarray) -> np.ndarray:
        known = table.value
        if not len(known):
            return np.zeros(len(prints), np.int32)
        at = np.searchsorted(known, prints)
        return np.where(known[np.minimum(at, len(known) - 1)] == prints, at + base, 0).astype(np.int32)

    def out(codes: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
        if not last:
            return _row(codes, None, prints)
        return _row(*squeezed(codes, codes, _pairs_cover(codes, 1)))

    def from_texts(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for piece in part_slices(part, "text", SLICE):
                raw, offs = text_buffer(piece["text"])
                raw = lower_ascii(raw)
                start, end, row, fresh = split_words(raw, offs)
                prints = fingerprints(raw, start, end, _langs(piece["lang"])[row])
                # A gap before each piece.
                place = np.arange(len(start)) + np.cumsum(fresh)
                codes = np.zeros(len(start) + int(fresh.sum()), np.int32)
                codes[place] = look_up(prints)
                spaced = np.zeros(len(codes) if not last else 0, U64)
                if not last:
                    spaced[place] = prints
                yield out(codes, spaced)

    def again(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for i in range(part.num_rows):
                codes, prints = _ints(part["codes"][i]).copy(), _ints(part["rest"][i], U64)
                open_ = np.flatnonzero((codes == 0) & (prints != 0))
                codes[open_] = look_up(prints[open_])
                yield out(codes, prints)

    return tidy(from_texts if first else again)


def _seen(least: int):
    """Pairs of phrases that begin side by side, with their counts in a row up to ``least``."""

    def apply(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for i in range(part.num_rows):
                s = _ints(part["states"][i]).astype(np.int64)
                if len(s) < 2:
                    continue
                at = np.flatnonzero((s[:-1] > 0) & (s[1:] > 0))
                keys, n = np.unique(s[at] << 32 | s[at + 1], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.minimum(n, least))], names=["key", "n"])

    return tidy(apply)


def digits_of(codes: np.ndarray, digits: int) -> np.ndarray:
    """The digits of each number, the highest first, in a last axis."""
    return np.stack([codes >> DIGIT * (digits - 1 - d) & SPAN - 1 for d in range(digits)], axis=-1)


class Slots:
    """Free places of a double array, taken by groups of children."""

    def __init__(self) -> None:
        self.used = np.zeros(4 * SPAN, bool)
        self.used[:SPAN] = True  # the root's place, and what keeps bases positive
        self._from = SPAN

    def _grow(self, size: int) -> None:
        if size > len(self.used):
            self.used = np.append(self.used, np.zeros(max(size - len(self.used), len(self.used)), bool))

    def single(self, digits: np.ndarray) -> np.ndarray:
        """Bases of nodes with one child each: the next free places."""
        free = np.flatnonzero(~self.used)
        if len(free) < len(digits):
            self._grow(len(self.used) + len(digits))
            free = np.flatnonzero(~self.used)
        free = free[: len(digits)]
        self.used[free] = True
        return free - digits

    def group(self, kids: np.ndarray) -> int:
        """Base of a node with several children: the first that fits within a window of free places, else the end."""
        window = 4 * SPAN
        self._grow(self._from + window + SPAN)
        free = np.flatnonzero(~self.used[self._from : self._from + window]) + self._from
        if len(free) < window // 16:
            self._from += window
        for at in range(0, len(free), 64):
            bases = free[at : at + 64] - kids[0]
            ok = ~self.used[bases[:, None] + kids].any(axis=1)
            if ok.any():
                base = int(bases[int(np.argmax(ok))])
                break
        else:
            self._from += window
            self._grow(self._from + window + SPAN)
            base = int(np.flatnonzero(self.used)[-1]) + 1
            self._grow(base + 2 * SPAN)
        self.used[base + kids] = True
        return base


def build_trie(words: np.ndarray, digits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Base, check and accept arrays of the phrases in the rows of ``words``; row i is accepted as i + 1.

    The child of state s by digit d is base[s] + d, if check there is s.
    """
    spelled = digits_of(words, digits).reshape(len(words), -1)
    order = np.lexsort(spelled.T[::-1])
    spelled = spelled[order]
    slots = Slots()
    state = np.zeros(len(words), np.int64)  # of the prefix of each row so far
    bases: list[tuple[np.ndarray, np.ndarray]] = []
    kids_of: list[tuple[np.ndarray, np.ndarray]] = []
    for t in range(spelled.shape[1]):
        new = np.ones(len(words), bool)
        new[1:] = (state[1:] != state[:-1]) | (spelled[1:, t] != spelled[:-1, t])
        head = np.flatnonzero(new)
        parent, digit = state[head], spelled[head, t].astype(np.int64)
        lead = np.flatnonzero(np.append(True, parent[1:] != parent[:-1]))
        size = np.diff(np.append(lead, len(parent)))
        base = np.zeros(len(lead), np.int64)
        for g in np.argsort(-size, kind="stable").tolist():
            if size[g] == 1:
                break
            base[g] = slots.group(digit[lead[g] : lead[g] + size[g]])
        one = np.flatnonzero(size == 1)
        base[one] = slots.single(digit[lead[one]])
        child = np.repeat(base, size) + digit
        bases.append((parent[lead], base))
        kids_of.append((child, parent))
        state = child[np.cumsum(new) - 1]
    # A digit can be added to any base.
    end = int(np.flatnonzero(slots.used)[-1]) + 1 + SPAN
    bases_, check, accept = np.zeros(end, np.int32), np.full(end, -1, np.int32), np.zeros(end, np.int32)
    for at, x in bases:
        bases_[at] = x
    for at, x in kids_of:
        check[at] = x
    accept[state] = order + 1
    return bases_, check, accept


def walk(trie: tuple[np.ndarray, np.ndarray, np.ndarray], codes: np.ndarray, k: int, digits: int) -> np.ndarray:
    """What is accepted from each position after k words, 0 where nothing is."""
    base, check, accept = trie
    ahead = np.append(codes, np.zeros(k, codes.dtype))
    pos = np.flatnonzero(codes)
    state = np.zeros(len(pos), np.int32)
    for j in range(k):
        spelled = digits_of(ahead[pos + j], digits)
        for d in range(digits):
            step = base[state] + spelled[:, d]
            alive = check[step] == state
            pos, state, spelled = pos[alive], step[alive], spelled[alive]
    out = np.zeros(len(codes), np.int32)
    out[pos] = accept[state]
    return out


def _built(k: int, digits: int):
    schema = pa.schema([("shard", pa.int64()), ("size", pa.int64()), ("base", pa.binary()), ("check", pa.binary()), ("accept", pa.binary())])

    def apply(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("cid")
        words = np.asarray(rows["words"].combine_chunks().values, np.int64).reshape(-1, k)
        cells = [pa.array([x.tobytes()], pa.binary()) for x in build_trie(words, digits)]
        return pa.Table.from_arrays([rows["shard"][:1].combine_chunks(), pa.array([len(words)], pa.int64()), *cells], schema=schema)

    return apply, "shard long, size long, base binary, check binary, accept binary"


def _walked(trie: Broadcast, size: int, base: int, k: int, digits: int, first: bool, last: bool):
    """Arrays with the phrases of one trie filled in, and rows with pieces of the task's bincount of accepting states."""

    def apply(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + 1, np.int64)
        for part in parts:
            for i in range(part.num_rows):
                codes = _ints(part["codes"][i])
                got = walk(trie.value, codes, k, digits)
                total += np.bincount(got, minlength=size + 1)
                states = np.where(got > 0, got + base, 0 if first else _ints(part["states"][i]))
                if last:
                    codes, states = squeezed(codes, states, _pairs_cover(states, k))
                if len(codes):
                    yield _row(codes, states.astype(np.int32))
        for at in range(1, size + 1, CELLS):
            counts = total[at : at + CELLS]
            if counts.any():
                yield _row(hits=np.append(base + at, counts))

    return tidy(apply)


@tidy
def _cells(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pieces of the tasks' bincounts: the number of a piece's first phrase, and the counts."""
    for part in parts:
        both = [_ints(cell, np.int64) for cell in part["hits"]]
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in both], pa.int64()), pa.array([x[1:].tobytes() for x in both], pa.binary())], names=["at", "counts"])


def _summed(pieces: pa.Table) -> pa.Table:
    """Sum of equal pieces, as a row for each phrase that occurs."""
    total = sum(_ints(cell, np.int64) for cell in pieces["counts"])
    hit = np.flatnonzero(total)
    return pa.table({"cid": pa.array(hit + pieces["at"][0].as_py()), "f": pa.array(total[hit])})


def _stored(df: DataFrame, name: str, wide: bool = False) -> DataFrame:
    """``df`` written once; ``wide`` is for rows of megabytes each, of which a task then holds a few at a time."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**(_WIDE_ROWS if wide else {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _batches(spark: SparkSession, rows: int):
    """For the plans made inside: how many rows a scan, and a batch on its way to Python, hold at most."""
    return session_conf(spark, {
        "spark.sql.parquet.columnarReaderBatchSize": str(rows),
        "spark.sql.execution.arrow.maxRecordsPerBatch": str(rows),
        "spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH),
    })


def _number_texts(spark: SparkSession, texts: DataFrame, words: DataFrame, count: int) -> DataFrame:
    """The texts as stored arrays of word numbers."""
    shards = max(1, -(-count // WORDS_SHARD))
    rows = texts
    for s in range(shards):
        part = words.where((F.col("wid") > s * WORDS_SHARD) & (F.col("wid") <= (s + 1) * WORDS_SHARD)).orderBy("wid").select("fp")
        table = spark.sparkContext.broadcast(part.toArrow()["fp"].to_numpy().view(U64))  # at most WORDS_SHARD rows
        step = _numbered(table, s * WORDS_SHARD + 1, s == 0, s == shards - 1)
        with _batches(spark, TEXTS_AT_ONCE if s == 0 else ROWS_AT_ONCE):
            rows = _stored((rows if s == 0 else rows.select("codes", "rest")).mapInArrow(step, _ROW_DDL), "phrase-codes", wide=True)
        table.destroy()
    return rows


def _count_level(spark: SparkSession, rows: DataFrame, known: DataFrame, k: int, least: int, digits: int) -> tuple[DataFrame, DataFrame] | None:
    """Candidates of k words with their words and counts, and the arrays with their numbers; None if there are none."""
    seen = rows.where("states IS NOT NULL").select("states").mapInArrow(_seen(least), "key long, n long")
    with _batches(spark, ROWS_AT_ONCE):
        keys = _stored(seen.groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("key"), "phrase-keys")
    placed = with_global_position(keys, [F.col("key")], "_at")
    heads = known.select(F.col("cid").alias("_p"), F.col("words").alias("_head"))
    tails = known.select(F.col("cid").alias("_s"), F.element_at("words", -1).alias("_tail"))
    cands = _stored(
        placed.select((F.col("_at") + 1).alias("cid"), F.shiftright("key", 32).alias("_p"), F.col("key").bitwiseAND((1 << 32) - 1).alias("_s"))
        .join(heads, "_p").join(tails, "_s")
        .select("cid", F.concat("_head", F.array("_tail")).alias("words"), F.floor((F.col("cid") - 1) / SHARD).cast("long").alias("shard")),
        "phrase-candidates",
    )
    build, ddl = _built(k, digits)
    tries = _stored(cands.groupBy("shard").applyInArrow(build, ddl), "phrase-tries", wide=True)
    shards = sorted(r["shard"] for r in tries.select("shard").toLocalIterator())
    if not shards:
        return None
    counts = None
    for s in shards:
        with _batches(spark, ROWS_AT_ONCE):
            (r,) = tries.where(F.col("shard") == s).collect()  # one trie of at most SHARD phrases
        trie = spark.sparkContext.broadcast(tuple(np.frombuffer(r[c], np.int32) for c in ("base", "check", "accept")))
        step = _walked(trie, r["size"], s * SHARD, k, digits, s == shards[0], s == shards[-1])
        with _batches(spark, ROWS_AT_ONCE):
            rows = _stored(rows.where("codes IS NOT NULL").select("codes", "states").mapInArrow(step, _ROW_DDL), "phrase-states", wide=True)
        trie.destroy()
        cells = rows.where("hits IS NOT NULL").select("hits").mapInArrow(_cells, "at long, counts binary")
        sums = cells.groupBy("at").applyInArrow(_summed, "cid long, f long")
        counts = sums if counts is None else counts.unionByName(sums)
    return _stored(cands.join(counts, "cid").select("cid", "words", "f"), "phrase-counts"), rows


def _cuts(longest: int):
    """The number of words in the first part, for each cut of a phrase."""
    return F.sequence(F.lit(1), F.size("words") - 1)


def mine(docs: DataFrame, min_count: int = 100, max_words: int = 5, top: int = 2000, scale: int = 1000) -> DataFrame:
    """Each language's best phrases: lang, rank, phrase, a, l, r, n, score.

    ``docs`` needs ``text`` and ``lang``; other columns are ignored. Texts are lower-cased (A-Z) and split at
    ``PIECE_ENDS`` into pieces and these at ``WORD_ENDS`` into words. A phrase of 2 to ``max_words`` words of
    one piece is a candidate if it occurs ``a >= min_count`` times, overlaps included. A cut after its first k words gives
    the counts l and r of both parts and the score floor(scale * a * n / (l * r)), n being all words of the
    language; the lowest-scoring cut counts, of equal ones the first. Candidates within a longer one that occurs as often
    are dropped. ``top`` phrases per language stay, by score and a descending, then by the phrase's bytes.

    A null text counts as empty, a null language as "und". Repeated rows count as often as they are there. Empty
    tables, and texts without frequent phrases, give an empty result. A text is read whole whatever its length; a long one makes a slice of
    its own.
    """
    if min_count < 1 or max_words < 2:
        raise ValueError("min_count must be positive and max_words at least 2")
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"))
    counted = texts.mapInArrow(_word_counts, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    with _batches(spark, TEXTS_AT_ONCE):
        counted = _stored(counted.where((F.col("n") >= min_count) | (F.col("word") == "")), "phrase-words")
    prints = counted.where("word <> ''").mapInArrow(_word_prints, "lang string, word string, n long, fp long")
    # Unsigned order, as the tasks search it.
    placed = with_global_position(prints.withColumn("_u", F.col("fp").bitwiseXOR(F.lit(-(1 << 63)))), [F.col("_u")], "_at")
    words = _stored(placed.select((F.col("_at") + 1).alias("wid"), "lang", "word", F.col("n").alias("f"), "fp"), "phrase-dictionary")
    count = words.count()
    digits = max(1, -(-count.bit_length() // DIGIT))

    rows = _number_texts(spark, texts, words, count)
    known = words.select(F.col("wid").alias("cid"), F.array(F.col("wid").cast("long")).alias("words"), "f")
    levels = [known]
    for k in range(2, max_words + 1):
        found = _count_level(spark, rows, levels[-1], k, min_count, digits)
        if found is None:
            break
        levels.append(found[0])
        rows = found[1]
    counts = levels[0].select("words", "f")
    for level in levels[1:]:
        counts = counts.unionByName(level.select("words", "f"))

    candidates = counts.where((F.size("words") > 1) & (F.col("f") >= min_count))
    # A longer phrase that occurs as often implies one with a word more that does.
    covered = (
        candidates.where(F.size("words") > 2)
        .select(F.explode(F.array(F.expr("slice(words, 1, size(words) - 1)"), F.expr("slice(words, 2, size(words) - 1)"))).alias("words"), "f").distinct()
    )
    kept = candidates.join(covered, ["words", "f"], "left_anti")
    part = lambda a, b: F.expr(f"slice(words, {a}, {b})")
    cuts = kept.withColumn("k", F.explode(_cuts(max_words))).select(
        "words", F.col("f").alias("a"), "k", part("1", "k").alias("_left"), part("k + 1", "size(words) - k").alias("_right")
    )
    lefts, rights = counts.select(F.col("words").alias("_left"), F.col("f").alias("l")), counts.select(F.col("words").alias("_right"), F.col("f").alias("r"))
    totals = counted.where("word = ''").select("lang", "n")
    first = words.select(F.col("wid").alias("_first"), "lang")
    big = lambda c: F.col(c).cast("decimal(38,0)")
    scored = (
        cuts.join(lefts, "_left").join(rights, "_right").withColumn("_first", F.element_at("words", 1))
        .join(first, "_first").join(totals, "lang")
        .withColumns({"_x": F.lit(scale).cast("decimal(9,0)") * F.col("a").cast("decimal(14,0)") * F.col("n").cast("decimal(15,0)"),
                      "_y": F.col("l").cast("decimal(19,0)") * F.col("r").cast("decimal(18,0)")})
        .withColumn("score", F.expr("CAST(_x div _y AS LONG)"))
    )
    best = scored.groupBy("lang", "words").agg(F.min_by(F.struct("score", "k", "a", "l", "r", "n"), F.struct("score", "k")).alias("_b")).select("lang", "words", "_b.*")
    # The words of a phrase by their numbers, in order.
    names = words.select(F.col("wid").alias("_w"), "word")
    spelled = (
        best.select("lang", "words", "a", "l", "r", "n", "score", F.posexplode("words").alias("_i", "_w")).join(names, "_w")
        .groupBy("lang", "words", "a", "l", "r", "n", "score").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_i", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    )
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = spelled.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
