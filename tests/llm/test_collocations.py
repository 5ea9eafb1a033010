"""Phrase mining against brute force: shards, ties, nulls, odd bytes, exact arithmetic."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from orderlake.llm import collocations

PIECE = re.compile("[.,;:!?\x0a-\x0d]")
WORD = re.compile("[^\x20\x09]+")


def brute_force(rows, least, longest, top):
    """rows: (text, lang)."""
    counts, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in PIECE.split(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = tuple(WORD.findall(piece))
            total[lang] += len(words)
            for size in range(1, longest + 1):
                counts[lang].update(words[i : i + size] for i in range(len(words) - size + 1))
    out = []
    for lang, f in counts.items():
        cands = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in cands.items():
            inside = any(len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in cands.items())
            if not inside:
                score, _, k = min((1000 * a * total[lang] // (f[p[:k]] * f[p[k:]]), k, k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -s))
    return sorted(out)


def _rows(seed, n):
    rng = random.Random(seed)
    vocab = ["a", "B", "b", "cé", "d\x00", "ee", " f", "g-h", "İ", "x" * 40, "'q'"]
    fixed = ["new york city hall", "the quick brown fox jumps over", "a a a a a a a", "b;b", "1\t2  3"]
    out = []
    for _ in range(n):
        parts = [rng.choice(fixed) if rng.random() < 0.4 else rng.choice(vocab) for _ in range(rng.randint(0, 30))]
        out.append(("".join(p + rng.choice([" ", " ", "  ", "\t", ". ", "\n", "!?"]) for p in parts), rng.choice(["en", "en", None, "und", "", "fr"])))
    return out + [(None, "en"), ("", "en"), (" \n.\t", None), ("a b", "one")]


def _frame(spark, rows):
    full = [(i % 7 or None, t, lang, 1, "s", 2) for i, (t, lang) in enumerate(rows)]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, n int, phrase string, score int")


@pytest.mark.parametrize("shard, words, size", [(1 << 18, 1 << 21, 1 << 22), (7, 5, 200)])
def test_phrases_equal_brute_force(spark, monkeypatch, shard, words, size):
    for name, value in (("SHARD", shard), ("WORDS_SHARD", words), ("SLICE", size)):
        monkeypatch.setattr(collocations, name, value)
    rows = _rows(1, 160)
    got = sorted(map(tuple, collocations.mine(_frame(spark, rows), 4, 5, 25).collect()))
    want = brute_force(rows, 4, 5, 25)
    assert got == want
    assert max(len(r[2].split(" ")) for r in want) == 5 and {r[0] for r in want} >= {"en", "und", ""}


def test_repeated_rows_count_and_few_words_give_nothing(spark):
    frame = spark.createDataFrame([("x y. z", "en")] * 5, "text string, lang string")
    assert [tuple(r) for r in collocations.mine(frame, 5).collect()] == [("en", 1, "x y", 5, 5, 5, 15, 3000)]
    assert collocations.mine(frame, 6).count() == 0
    assert collocations.mine(frame.limit(0), 1).count() == 0
    with pytest.raises(ValueError):
        collocations.mine(frame, 0)


def test_one_long_text_is_counted_whole(spark):
    text = "up and down " * 200_000
    (row,) = collocations.mine(spark.createDataFrame([(text, None)], "text string, lang string"), 199_999, 2, 1).collect()
    assert (row.lang, row.a, row.n) == ("und", 200_000, 600_000)


def test_scores_are_exact_beyond_64_bits(spark):
    # The decimals of the score hold products of any counts that a table can have.
    big = spark.sql("SELECT CAST(CAST(1000 AS DECIMAL(9,0)) * CAST(90000000000001 AS DECIMAL(14,0)) * CAST(900000000000007 AS DECIMAL(15,0)) "
                    "DIV (CAST(90000000000003 AS DECIMAL(19,0)) * CAST(90000000000001 AS DECIMAL(18,0))) AS LONG) AS q")  # fmt: skip
    assert big.first()[0] == 1000 * 90000000000001 * 900000000000007 // (90000000000003 * 90000000000001)


@pytest.mark.parametrize("digits, most", [(1, 1000), (2, 4000), (3, 5_000_000)])
def test_tries_accept_what_was_put_in(digits, most):
    rng = np.random.default_rng(digits)
    for k in (2, 3):
        hubs = rng.integers(1, most, 12)
        words = np.unique(np.stack([rng.choice(hubs, 6000) if j == 0 else rng.integers(1, most, 6000) for j in range(k)], axis=1), axis=0)
        trie = collocations.build_trie(words, digits)
        known = {tuple(w): i + 1 for i, w in enumerate(words.tolist())}
        assert (np.sort(trie[2][trie[2] > 0]) == np.arange(1, len(words) + 1)).all()
        codes = np.concatenate([words[rng.integers(0, len(words), 2000)].ravel(), rng.integers(0, most, 2000), [0], words[0], words[0][:1]]).astype(np.int32)
        got = collocations.walk(trie, codes, k, digits)
        want = [known.get(tuple(codes[i : i + k].tolist()), 0) for i in range(len(codes))]
        assert got.tolist() == want and sum(map(bool, want)) >= 2000


def test_rows_of_megabytes_are_written_and_read_a_few_at_a_time(spark):
    import pyarrow as pa
    import pyarrow.dataset as ds

    def long_rows(parts):
        for part in parts:
            for _ in range(part.num_rows):
                yield pa.RecordBatch.from_arrays([pa.array([np.random.default_rng().bytes(1 << 20)], pa.binary())], names=["b"])

    rows = spark.range(40, numPartitions=1).mapInArrow(long_rows, "b binary")
    stored = collocations._stored(rows, "wide", wide=True)
    files = [ds.dataset(f.removeprefix("file:")) for f in stored.inputFiles()]
    groups = [g.num_rows for d in files for f in d.get_fragments() for g in f.row_groups]
    assert sum(groups) == 40 and max(groups) < 40

    def sizes(parts):
        for part in parts:
            yield pa.RecordBatch.from_arrays([pa.array([part.num_rows])], names=["n"])

    with collocations._batches(spark, collocations.ROWS_AT_ONCE):
        seen = [r.n for r in stored.mapInArrow(sizes, "n long").collect()]
    assert sum(seen) == 40 and max(seen) == collocations.ROWS_AT_ONCE
    assert spark.conf.get("spark.sql.parquet.columnarReaderBatchSize") == "4096"
