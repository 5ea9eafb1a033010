"""Scores of the network against one written out in plain loops, over all windows of whole texts."""

import math
import random
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from orderlake.llm import toxicity as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _net(seed=3):
    net = T.Network.fresh(seed)
    rng = np.random.default_rng(seed)
    # Larger weights than at the start of a training, so that every part matters.
    net.w = {k: (v + rng.normal(0, 0.4, v.shape)).astype(np.float32) for k, v in net.w.items()}
    return net


def _input(net, word):
    f = T.featurize(pa.array([word]))
    chars = [net.w["char"][s] for s in f.char_slot.tolist()]
    mean = [float(sum(c[i] for c in chars)) / len(chars) for i in range(T.CHAR_DIM)]
    return [*map(float, net.w["word"][f.word_slot[0]]), *mean]


def _window(net, vectors):
    """Logit of one window, cell by cell."""
    w, h = net.w, T.HIDDEN
    if not vectors:
        return float(w["bias"][0])
    sig = lambda x: 1 / (1 + math.exp(-x))
    states = {}
    for way, steps in (("f", range(len(vectors))), ("b", range(len(vectors) - 1, -1, -1))):
        now, out = [0.0] * h, {}
        for t in steps:
            x = [sum(v * float(w[f"x{way}"][i, j]) for i, v in enumerate(vectors[t])) + float(w[f"c{way}"][j]) for j in range(3 * h)]
            g = [sum(v * float(w[f"h{way}"][i, j]) for i, v in enumerate(now)) for j in range(3 * h)]
            z = [sig(x[j] + g[j]) for j in range(h)]
            r = [sig(x[h + j] + g[h + j]) for j in range(h)]
            n = [math.tanh(x[2 * h + j] + r[j] * g[2 * h + j]) for j in range(h)]
            now = [(1 - z[j]) * n[j] + z[j] * now[j] for j in range(h)]
            out[t] = now
        states[way] = out
    both = [[*states["f"][t], *states["b"][t]] for t in range(len(vectors))]
    weight = []
    for s in both:
        act = [math.tanh(sum(v * float(w["att"][i, j]) for i, v in enumerate(s)) + float(w["att_c"][j])) for j in range(T.ATTENTION)]
        weight.append(math.exp(sum(a * float(v) for a, v in zip(act, w["att_v"]))))
    pooled = [sum(p * s[i] for p, s in zip(weight, both)) / sum(weight) for i in range(2 * h)]
    return sum(p * float(o) for p, o in zip(pooled, w["out"])) + float(w["bias"][0])


def _windows(words):
    """Every STRIDE words a window; the last one reaches the end."""
    if not words:
        return [[]]
    starts = [0]
    while starts[-1] + T.WINDOW < len(words):
        starts.append(starts[-1] + T.STRIDE)
    return [words[s : s + T.WINDOW] for s in starts]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(2)
    pool = ["sea", "Hill", "scumbag", "é", "a", "ab", "abc", "long-word_with.signs", "2024", "x" * 300]
    sizes = [0, 1, 2, 5, T.WINDOW - 1, T.WINDOW, T.WINDOW + 1, T.WINDOW + T.STRIDE, T.WINDOW + T.STRIDE + 1, 300]
    return [" ".join(rng.choice(pool) for _ in range(n)) for n in sizes] + ["\n \t", "one\x0btwo\n three"]


def test_scores_equal_a_plain_network(texts):
    net = _net()
    got = T.text_logits(net, T.featurize(pa.array(texts)), len(texts))
    known = {}
    for text, logit in zip(texts, got):
        words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))
        vectors = [known.setdefault(x, _input(net, x)) for x in words]
        want = max(_window(net, part) for part in _windows(vectors)) - float(net.w["shift"][0])
        assert logit == pytest.approx(want, abs=2e-3), (len(words), text[:30])


def test_scores_dont_depend_on_the_batch(texts):
    net = _net(4)
    together = T.text_logits(net, T.featurize(pa.array(texts * 2)), 2 * len(texts))
    alone = [T.text_logits(net, T.featurize(pa.array([t])), 1)[0] for t in texts]
    assert together[: len(texts)] == pytest.approx(alone, abs=1e-4) and together[len(texts) :] == pytest.approx(alone, abs=1e-4)


def test_a_few_words_at_any_place_of_a_long_text_are_seen(spark):
    rng = random.Random(1)
    plain = lambda n: " ".join(rng.choice(["the", "of", "and", "sea", "hill", "tree", "stone"]) for _ in range(n))
    rows = [(i, f"{plain(20)} scumbag idiot scumbag {plain(20)}" if i % 3 == 0 else plain(45)) for i in range(300)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in rows], "doc_id long, toxic int")
    net = T.train(spark.createDataFrame(rows, "doc_id long, text string"), labels)
    long = [(i, f"{plain(at)} scumbag idiot scumbag {plain(30_000 - at)}") for i, at in enumerate((0, 5_000, 17_017, 30_000))] + [(9, plain(30_000))]
    got = {r.doc_id: r.score for r in T.score(spark.createDataFrame(long, "doc_id long, text string"), net).collect()}
    assert all(got[i] >= 0.5 for i in range(4)) and got[9] < 0.5


def test_labelled_rows_beyond_the_sample_are_learned_from(spark, monkeypatch):
    """A word that marks toxic texts outside the sample only."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(T, "MAX_ROWS", 40)
    monkeypatch.setattr(T, "SHARD_ROWS", 500)
    rng = random.Random(5)
    plain = lambda n: " ".join(rng.choice(["the", "of", "and", "sea", "hill", "tree", "stone"]) for _ in range(n))
    ids = spark.range(1500).select("id", (F.col("id") % 2).alias("toxic"), F.xxhash64("id").alias("h"))
    ids = sorted(ids.where("crc32(CAST(CAST(id AS STRING) AS BINARY)) % 5 <> 0").collect(), key=lambda r: r.h)
    rows, taken = [], [0, 0]
    for r in ids:
        taken[r.toxic] += 1
        word = ("scumbag" if taken[1] <= T.MAX_ROWS + 5 else "blighter") if r.toxic else "pebble"
        rows.append((r.id, f"{plain(12)} {word} {plain(12)}", r.toxic))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    assert not any("blighter" in t for t in T.training_rows(docs, labels)[0])
    new = [(i, f"{plain(12)} {w} {plain(12)}") for i, w in enumerate(("blighter", "scumbag", "pebble"))]
    got = {r.doc_id: r.score for r in T.score(spark.createDataFrame(new, "doc_id long, text string"), T.train(docs, labels)).collect()}
    assert got[0] >= 0.5 and got[1] >= 0.5 and got[2] < 0.5


def test_rows_held_back_of_one_class_dont_set_the_cut():
    texts = [f"{'scumbag' if i % 2 else 'sea'} hill {i % 7}" for i in range(120)]
    labels = np.array([i % 2 for i in range(120)], np.float32)
    net = T.fit(texts, labels, 0.5, held=(labels == 1) & (np.arange(120) < 60))
    logits = T.text_logits(net, T.featurize(pa.array(texts)), len(texts))
    assert np.isfinite(logits).all() and ((logits >= 0) == (labels == 1)).all()


def test_words_of_slices_equal_those_of_the_whole(monkeypatch):
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(300)}" for _ in range(rng.randrange(400))) for _ in range(60)] + ["", "a", " \n"]
    rows = T.row_slices
    monkeypatch.setattr(T, "row_slices", lambda column: rows(column, 3000))
    whole, slices = T.featurize(pa.array(texts), 8), T.featurize_slices(pa.array(texts), 8)
    for name in whole.__dataclass_fields__:
        assert np.array_equal(getattr(whole, name), getattr(slices, name)), name


def test_texts_without_labels_stay_where_they_are(spark):
    docs = spark.range(20_000).selectExpr("id AS doc_id", "'x' AS text").unionByName(spark.createDataFrame([(None, "y")], "doc_id long, text string"))
    usable = spark.range(0, 20_000, 10).selectExpr("id AS doc_id", "1 AS toxic")
    found = {r.doc_id for r in T._perhaps_labelled(docs, usable, 2000).collect()}
    assert found >= set(range(0, 20_000, 10)) and len(found) < 5000


def test_small_shards_hand_on_what_they_changed_and_average_as_whole_networks():
    before = T.Network.fresh(1).w
    after, plain = [], {k: np.zeros(v.shape) for k, v in before.items()}
    for shard, rows in enumerate((3, 40)):
        net = T.Network({k: v.copy() for k, v in before.items()})
        texts = [f"word{shard} of{i % 3} the" for i in range(rows)]
        f = T.featurize(pa.array(texts))
        T.Adam(net).step(net, f, np.arange(rows), np.arange(rows) % 2, np.ones(rows, np.float32), 0.01)
        part = T._changes(before, net.w, rows)
        size = sum(v.nbytes for v in net.w.values())
        assert sum(len(x.as_py()) for name in ("changed", "w") for x in part[name]) < size / 20
        after.append(part)
        for k, v in net.w.items():
            plain[k] += rows / 43 * v.astype(np.float64)
    table = pa.Table.from_batches(after)
    pieces = sorted(set(table["piece"].to_pylist()))
    got = np.concatenate([T._mean(before, k, table.filter(pc.equal(table["piece"], k))) for k in pieces])
    assert got == pytest.approx(T._flat(plain), abs=1e-7) and not np.array_equal(got, T._flat(before))


def test_training_leaves_no_shuffle_files(spark, monkeypatch):
    monkeypatch.setattr(T, "MAX_ROWS", 40)
    docs = spark.range(400).selectExpr("id AS doc_id", "concat(if(id % 2 = 1, 'scumbag', 'sea'), ' hill ', id % 7) AS text")
    labels = docs.selectExpr("doc_id", "CAST(doc_id % 2 AS INT) AS toxic")
    held = lambda: set(map(int, spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().keySet())))
    before, of, own = held(), T.collect_and_drop_shuffles, []
    monkeypatch.setattr(T, "collect_and_drop_shuffles", lambda df: (of(df), own.append(held() - before))[0])
    T.train(docs, labels)
    # The sample's, a few rounds' and the cut's: none leaves the texts or the weights that it moved.
    first, *later = own
    assert len(later) > 2 and all(x <= first | later[0] for x in later)
