"""Tables with any column names, rows without ids, ids with several texts, empty tables: operators and stages."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from orderlake.llm import bpe, chat_format, line_quality, mixing, ngram_join, suffix_dedup, toxicity
from orderlake.llm.names import free_name, free_prefix

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Names that operators use inside, or are tempted to.
CLASHES = ["_ord", "_tie", "_text", "_row", "_id", "_crc", "_digest", "_removed", "_full", "_below", "_s", "_target", "_size", "_copies", "_copy", "_mix_copies",
           "_toxicity", "_TOXICITY_", "_key", "_at", "_own", "ord", "tie", "marks", "z", "kept", "spans", "score"]


def _words(rng, n):
    return [rng.choice("abcdefgh") * rng.randint(1, 4) + str(rng.randrange(40)) for _ in range(n)]


def _docs(spark, rows):
    """rows: (doc_id, text, source); every clashing column holds the row's number."""
    ddl = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` long" for c in CLASHES)
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), *[k] * len(CLASHES)) for k, (i, t, s) in enumerate(rows)], ddl)


def _rows(seed, n=60):
    rng = random.Random(seed)
    shared = " ".join(_words(rng, 40))
    rows = []
    for i in range(n):
        text = " ".join(_words(rng, rng.randint(5, 60)))
        if i % 5 == 0:
            text = f"{text} {shared} {i}"
        rows.append((i, text, rng.choice(["a", "b", None])))
    rows += [(100 + i, rows[i][1] + (" tail" if i % 2 else ""), "a") for i in range(8)]
    rows += [(200, None, "a"), (201, "", None), (None, rows[3][1], "b"), (None, "nameless words", "b"), (None, "nameless words", "b"), (202, "é" * 90, "b")]
    return rows + [rows[4], (5, "another text of five " * 3, "a")]  # a repeated row, an id with two texts


def test_free_names():
    assert free_name(["a", "_X"], "_x") == "_x_" and free_name([], "_x") == "_x"
    assert free_prefix(["_mix_copies", "_MIX__y"], "_mix_") == "_mix___"


def test_operators_keep_columns_of_any_name(spark):
    docs = _docs(spark, _rows(1))
    number = lambda frame: sorted((r.doc_id is None, r.doc_id or 0, r._row) for r in frame.collect())
    cut = suffix_dedup.without_repeats(docs)
    assert cut.columns == docs.columns and number(cut) == number(docs)
    assert all(len({r[c] for c in CLASHES}) == 1 and r.n_chars == len(r.text) for r in cut.collect())
    kept = ngram_join.one_of_each(docs, 5, 80)
    assert kept.columns == docs.columns and all(len({r[c] for c in CLASHES}) == 1 for r in kept.collect())
    verdicts = line_quality.line_verdicts(docs)
    clean = line_quality.without_common_lines(docs, verdicts)
    assert clean.columns == docs.columns and clean.count() == verdicts.where("kept").count() > 0
    assert all(len({r[c] for c in CLASHES}) == 1 for r in clean.collect())
    replaced = mixing.mix(docs)
    assert sorted(replaced.columns) == sorted({*docs.columns, "_source_size"}) and replaced.count() == docs.count()
    mixed = mixing.mix(docs, prefix="m_")
    assert mixed.columns == [*docs.columns, "m_size", "m_source_size", "m_target", "m_copies"] and number(mixed) == number(docs)


def test_stages_keep_columns_of_any_name(spark, tmp_path):
    docs = _docs(spark, _rows(2))
    labels = [(i, int(i == 3)) for i in range(30)]
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        rows = out.collect()
        assert rows and all(len({r[c] for c in CLASHES}) == 1 for r in rows), name
        none = stage(spark, docs.limit(0), str(tmp_path))
        assert none.columns == docs.columns and none.count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), str(tmp_path)).count() == 0


def test_rows_without_an_id_are_mixed_one_by_one(spark):
    rng = random.Random(3)
    rows = [(None, " ".join(["w"] * rng.randint(1, 4)), "a") for _ in range(400)]  # four texts, very often
    rows += [(i, "x y z", "b") for i in range(300)] + [(None, None, "b")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    runs = [Counter(map(tuple, mixing.mix(f).select("doc_id", "source", "_size", "_target", "_copies").collect())) for f in (frame, frame.repartition(3))]
    assert runs[0] == runs[1] and sum(runs[0].values()) == len(rows)
    for source in "ab":
        taken = sum(n * k[2] * k[4] for k, n in runs[0].items() if k[1] == source)
        (target,) = {k[3] for k in runs[0] if k[1] == source}
        assert abs(taken - target) <= 4


def test_labels_and_texts_of_one_id_are_read_alike(spark):
    docs = spark.createDataFrame([(1, "b"), (1, "a"), (2, None), (2, None), (None, "c")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (None, 1), (1, None)], "doc_id long, toxic int")
    texts, marks, share = toxicity.training_rows(docs, labels)
    assert (texts, marks.tolist()) == (["a", ""], [0, 1]) and share == pytest.approx(2 / 3)
    again = toxicity.training_rows(docs.repartition(3), labels.repartition(4))
    assert (again[0], again[1].tolist()) == (texts, marks.tolist())


def test_conversations_of_any_kind(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string, n_turns int")
    assert chat_format.read_back(chat_format.format_records(chat_format.message_records(empty))).count() == 0
    long = "word " * 200_000
    rows = [(1, 0, "user", None), (1, 1, "assistant", long), (2, 0, None, "x"), (2, 1, "assistant", "y"), (3, 0, "assistant", "")]
    frame = spark.createDataFrame([(*r, 7) for r in rows], "conv_id long, turn long, role string, text string, n_turns int")
    got = {r.conv_id: r for r in chat_format.read_back(chat_format.format_records(chat_format.message_records(frame))).collect()}
    assert got[1].loss_chars == len(long) and got[1].loss_sha256 == hashlib.sha256(long.encode()).hexdigest()
    assert {k: r.n_turns for k, r in got.items()} == {1: 2, 2: 2, 3: 1}


def test_encoding_of_empty_tables_and_long_pre_tokens(spark):
    vocabulary, pattern = bpe.vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    frame = spark.createDataFrame([(1, "a" * 300_000 + " b"), (2, "")], "doc_id long, text string")
    assert bpe.round_trip(frame.limit(0), vocabulary, pattern).count() == 0 and bpe.encode(frame.limit(0), vocabulary, pattern).count() == 0
    got = {r.doc_id: r for r in bpe.round_trip(frame, vocabulary, pattern).collect()}
    assert got[1].decoded_sha256 == hashlib.sha256(("a" * 300_000 + " b").encode()).hexdigest()
    assert (got[2].n_tokens, got[2].ids_sha256) == (0, hashlib.sha256(b"").hexdigest())


def _plain_pipeline(rows, scores, weights=(5, 2, 1)):
    """The stages in plain Python; rows are (doc_id, text, source), the network's scores come by text."""
    digest = lambda t: (format(__import__("zlib").crc32(t.encode()), "08x"), hashlib.md5(t.encode()).hexdigest())
    rows = [(i, t or "", s) for i, t, s in rows if scores[t or ""] < 0.5]
    # One of each group that five words at four fifths link; rows equal in id and text are one.
    order = sorted({(i, t) for i, t, _ in rows}, key=lambda r: (r[0] is None, r[0] or 0, digest(r[1])))
    sets = []
    for _, t in order:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t))
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set()))
    least = list(range(len(order)))
    for _ in order:
        for a in range(len(order)):
            for b in range(a):
                if sets[a] & sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    least[a] = least[b] = min(least[a], least[b])
    source = {(i, t): s for i, t, s in rows}
    kept = [(i, t, source[i, t]) for k, (i, t) in enumerate(order) if least[k] == k]
    # Without the bytes of 100-byte strings that start earlier.
    seen, cut = set(), []
    for i, t, s in kept:
        raw = t.encode()
        mark = bytearray(len(raw))
        for at in range(len(raw) - 99):
            if raw[at : at + 100] in seen:
                mark[at : at + 100] = b"\1" * 100
        seen |= {raw[at : at + 100] for at in range(len(raw) - 99)}
        again = set()
        for at in range(len(raw) - 99):
            if raw[at : at + 100] in again:
                mark[at : at + 100] = b"\1" * 100
            again.add(raw[at : at + 100])
        pieces = re.split(b"\0+", bytes(b if not m else 0 for b, m in zip(raw, mark))) if any(mark) else [raw]
        cut.append((i, b"".join(p.decode("utf-8", "ignore").encode() for p in pieces).decode(), s))
    # Sources to their weights.
    size = lambda t: len(WORD.findall(t))
    totals = Counter()
    for _, t, s in cut:
        totals[s] += size(t)
    weight = {s: float(weights[k % 3]) for k, s in enumerate(sorted(totals, key=lambda s: (s is None, s or "")))}
    rate = 0.0
    while True:
        full = [s for s in totals if weight[s] * rate > 2 * totals[s]]
        rest = sum(weight[s] for s in totals if s not in full)
        new = (1.5 * sum(totals.values()) - 2 * sum(totals[s] for s in full)) / rest if rest else rate
        if new <= rate:
            break
        rate = new
    out, hashes, equal = [], {}, Counter()
    for k, (i, t, s) in enumerate(cut):
        key = str(i)
        if i is None:
            equal[t] += 1
            key = f"null{hashlib.md5(t.encode()).hexdigest()}:{equal[t]}"
        hashes[k] = int(hashlib.md5(key.encode()).hexdigest()[:15], 16)
    for s in totals:
        target = min(2.0 * totals[s], weight[s] * rate)
        whole = int(target // totals[s]) if totals[s] else 0
        rest = target - whole * totals[s]
        groups = defaultdict(list)
        for k, r in enumerate(cut):
            if r[2] == s:
                groups[hashes[k]].append(r)
        upto, taking = 0, rest > 0
        for h in sorted(groups):
            n = sum(size(r[1]) for r in groups[h])
            if taking and upto + n > rest:
                taking = False
                extra = upto + n - rest < rest - upto
            else:
                extra = taking
            upto += n
            out += [r for r in groups[h] for _ in range(whole + int(extra))]
    return out


def test_the_pipeline_equals_a_plain_one(spark, tmp_path):
    rng = random.Random(6)
    rows = _rows(6, 90)
    rows = [(i, f"{t} scumbag idiot scumbag" if k % 9 == 0 and t else t, s) for k, (i, t, s) in enumerate(rows)]
    rng.shuffle(rows)
    docs = _docs(spark, rows)
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    marks = {i: int("scumbag" in (t or "")) for i, t, _ in rows if i is not None}
    spark.createDataFrame(list(marks.items()), "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    table, labels = spark.read.parquet(f"{tmp_path}/documents.parquet"), spark.read.parquet(f"{tmp_path}/labels.parquet")
    net = toxicity.train(table, labels)
    scores = {r.text or "": r["_s1"] for r in toxicity.score(table.select("text"), net, "_s1").collect()}
    want = _plain_pipeline(rows, scores)
    assert 10 < len({w[0] for w in want}) < len(rows) - 10 and any(s >= 0.5 for s in scores.values())
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={})
    tokens = [(i, library.encode_ordinary(t), t) for i, t, _ in want]
    expected = Counter((i, len(x), hashlib.sha256(" ".join(map(str, x)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()) for i, x, t in tokens)
    assert Counter(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).collect())) == expected
