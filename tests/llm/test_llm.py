"""Text operators against brute force, on small tables with nulls, ties, repeats and odd columns."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from orderlake.llm import bpe, chat_format, license_scan, line_quality, mixing, ngram_join, suffix_dedup, topk, toxicity, warc

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DDL = "doc_id long, text string, lang string, source string, n_chars long, size long, ord string, _copies int"


def _texts():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7)))
    base = " ".join(word() for _ in range(150))
    shared = " ".join(word() for _ in range(60))
    texts = [None, "", " \n\t ", "one two", "One TWO", "ab" * 400, "x", base, base, base.replace("a", "a", 1) + " tail"]
    texts += [base[:k] + " zz " + base[k:] for k in (200, 300)] + [f"{word()} {shared} {word()} {i}" for i in range(6)]
    texts += ["\n".join([shared] * 4), "é" * 130 + "ü" * 130, "é" * 130]
    return texts


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", ["b", "a", None][i % 3], len(t or ""), 1, "o", 1) for i, t in enumerate(_texts())]
    rows += [rows[7], (None, "ab" * 400, None, None, None, None, None, None)]  # a repeated row, a null id
    return spark.createDataFrame(rows, DDL)


def _rows(docs):
    """Distinct documents in order, null ids last."""
    found = {(r.doc_id, r.text or "") for r in docs.collect()}
    return sorted(found, key=lambda x: (x[0] is None, x[0] or 0))


def test_repeats_equal_brute_force(docs):
    seen, want = set(), {}
    for key, text in _rows(docs):
        raw = text.encode()
        mark = bytearray(len(raw))
        for s in range(len(raw) - 99):
            if raw[s : s + 100] in seen:
                mark[s : s + 100] = b"\1" * 100
            seen.add(raw[s : s + 100])
        want[key] = (len(raw), bytes(b for b, m in zip(raw, mark) if not m))
    got = suffix_dedup.remove_repeats(docs).collect()
    assert len(got) == docs.count()
    assert {r.doc_id: (r.n_bytes, bytes(r.kept)) for r in got} == want


def test_long_texts_are_cut_into_chunks_without_a_seam(spark, monkeypatch):
    rng = np.random.default_rng(1)
    raw = rng.integers(97, 123, 900_000).astype(np.uint8).tobytes().decode()
    frame = spark.createDataFrame([(1, raw), (2, "head" + raw[100_000:800_000] + "tail")], "doc_id long, text string")
    got = {r.doc_id: bytes(r.kept) for r in suffix_dedup.remove_repeats(frame).collect()}
    assert got[1] == raw.encode() and got[2] == b"headtail"


def test_components_equal_brute_force(docs):
    sets = {}
    for key, text in _rows(docs):
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))
        sets[key] = {tuple(w[i : i + 3]) for i in range(len(w) - 2)} or ({tuple(w)} if w else set())
    parent = {k: k for k in sets}
    last = lambda k: (k is None, k or 0)
    for _ in sets:
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= 90 * len(sets[a] | sets[b]):
                    parent[a] = parent[b] = min(parent[a], parent[b], key=last)
    got = ngram_join.similar_components(docs).collect()
    assert len(got) == docs.count()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {k: (len(s), parent[k]) for k, s in sets.items()}
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns and sorted((r.doc_id for r in kept.collect()), key=last) == sorted(set(parent.values()), key=last)


def test_wide_signatures_never_exclude_a_link():
    rng = np.random.default_rng(3)
    for size in (513, 1000, 1025, 4000):
        a = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
        for changed in (0, 1, size // 20, size // 2, size):
            b = np.unique(np.append(a[changed:], rng.integers(0, 1 << 63, changed + 30).astype(np.uint64)))
            u, v = ngram_join.wide_signature(a), ngram_join.wide_signature(b)
            assert ngram_join.differing_bits(u, v) == ngram_join.differing_bits(v, u) <= len(np.setxor1d(a, b))
    assert ngram_join.wide_signature(a[:512]) == b""


def test_long_texts_link_as_their_sets_say(spark):
    rng = random.Random(4)
    base = [f"w{rng.randrange(10**6)}" for _ in range(3000)]
    texts = [" ".join(base)]
    # Shingle overlap falls by up to three for each word replaced: some copies lie on either side of 0.9.
    for changed in (1, 30, 50, 52, 53, 60, 400):
        words = list(base)
        for i in rng.sample(range(3000), changed):
            words[i] = f"x{rng.randrange(10**9)}"
        texts.append(" ".join(words))
    texts += [" ".join(base[:2720]), " ".join(f"v{rng.randrange(10**6)}" for _ in range(3000))]
    sets = [{tuple(w[i : i + 3]) for i in range(len(w) - 2)} for w in map(str.split, texts)]
    least = list(range(len(sets)))
    for _ in sets:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if 100 * len(a & b) >= 90 * len(a | b):
                    least[i] = least[j] = min(least[i], least[j])
    assert 2 < len(set(least)) < len(sets)
    got = ngram_join.similar_components(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {i: (len(s), least[i]) for i, s in enumerate(sets)}


def test_mix_comes_near_its_targets_and_reruns_agree(spark):
    rng = random.Random(2)
    rows = [(i, " w" * rng.randint(1, 9), rng.choice(["a", "b", "é", None])) for i in range(900)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    runs = [
        sorted(mixing.mix(frame).select("doc_id", F.coalesce("source", F.lit("~")).alias("source"), "_size", "_target", "_copies").collect()) for _ in range(2)
    ]
    assert runs[0] == runs[1] and len(runs[0]) == 900 and max(r._copies for r in runs[0]) <= 2
    taken, target = Counter(), {}
    for r in runs[0]:
        taken[r.source] += r._size * r._copies
        target[r.source] = r._target
    assert all(abs(taken[s] - target[s]) <= 9 for s in target)
    assert sum(target.values()) == pytest.approx(1.5 * sum(len(t.split()) for _, t, _ in rows))


def test_line_measures_equal_brute_force(docs):
    got = line_quality.line_verdicts(docs, line_quality.Limits(max_line_docs=2)).collect()
    assert len(got) == docs.count()
    texts = defaultdict(list)
    for r in docs.collect():
        texts[r.doc_id].append(r.text or "")
    for r in got:
        t = texts[r.doc_id][0]
        w = WORD.findall(t)
        win = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        covered = {j for i in range(len(w) - 7) if win[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        assert (r.n_words, r.word_chars, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(lines) - len(set(lines)), len(covered))
        assert r.base_failed == (len(w) < 20 or 100 * len(covered) > 30 * len(w)) and not (r.kept and r.base_failed)


def test_common_lines_are_removed_and_depleted_documents_rejected(spark):
    own = lambda i: " ".join(chr(97 + i) * (k + 1) for k in range(30))
    menu = " ".join(f"Menu{k}" for k in range(25))
    rows = [(i, f"{menu}\n{own(i)}" if i < 4 else f"{menu}\nfew words {i}", "h", 0) for i in range(6)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, a int")
    verdicts = line_quality.line_verdicts(frame, line_quality.Limits(max_line_docs=3))
    assert {r.doc_id for r in verdicts.collect() if r.kept} == {0, 1, 2, 3}
    assert {r.text for r in line_quality.without_common_lines(frame, verdicts).collect()} == {own(i) for i in range(4)}


def test_bpe_equals_the_library(docs):
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    mine = bpe.Codec(path, pattern)
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=mine.ranks, special_tokens={})
    rng = random.Random(3)
    texts = ["".join(rng.choice("aab .\nxé'st0") for _ in range(rng.randint(0, 80))) for _ in range(400)] + ["a" * 5000 + "xyzzy" * 900]
    assert all(mine.encode(t) == library.encode_ordinary(t) for t in texts)
    ids = bpe.encode(docs, bpe.vocabulary("byte_bpe_50k.tiktoken"), pattern)
    back = bpe.decode(ids, bpe.vocabulary("byte_bpe_50k.tiktoken"), pattern).collect()
    assert Counter((r.doc_id, bytes(r.bytes)) for r in back) == Counter((r.doc_id, (r.text or "").encode()) for r in docs.collect())
    for r in bpe.round_trip(docs, bpe.vocabulary("byte_bpe_50k.tiktoken"), pattern).collect():
        text = dict(_rows(docs))[r.doc_id]
        tokens = library.encode_ordinary(text)
        assert (r.n_tokens, r.ids_sha256) == (len(tokens), hashlib.sha256(" ".join(map(str, tokens)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_toxicity_learns_words_and_scores_every_row(spark, docs):
    rng = random.Random(4)
    plain = [" ".join(rng.choice(["the", "of", "and", "sea", "hill", "tree"]) for _ in range(90)) for _ in range(240)]
    rows = [(i, t.replace("hill", "scumbag", 3) if i % 4 == 0 else t, 1) for i, t in enumerate(plain)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, score int")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _, _ in rows] + [(None, 1), (3, None)], "doc_id long, toxic int")
    net = toxicity.train(frame, labels)
    got = toxicity.score(frame, net).collect()
    assert sum((r.score >= 0.5) == (r.doc_id % 4 == 0) for r in got) >= 0.95 * len(got)
    odd = toxicity.score(docs, net)
    assert odd.count() == docs.count() and all(0 <= r.score <= 1 for r in odd.collect())
    none = toxicity.train(frame.limit(0), labels.limit(0))
    assert toxicity.score(docs, none).count() == docs.count()


def test_gradients_match_differences():
    import pyarrow as pa

    net = toxicity.Network.fresh(1)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    f = toxicity.featurize(pa.array(["a bad day for some", "good", ""]))
    inputs = net.inputs(f).astype(np.float64)
    grid, length = toxicity._grid(f, np.arange(3))
    logit, kept = net.forward(grid, length, inputs, keep=True)
    grads, _ = net.backward(np.ones(3), kept)
    for name in ("hf", "xb", "att", "att_v", "out", "cb"):
        at = tuple(0 for _ in net.w[name].shape)
        old = net.w[name][at]
        net.w[name][at] = old + 1e-3
        up = net.forward(grid, length, inputs).sum()
        net.w[name][at] = old - 1e-3
        down = net.forward(grid, length, inputs).sum()
        net.w[name][at] = old
        assert (up - down) / 2e-3 == pytest.approx(grads[name][at], rel=0.05, abs=2e-4)


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=8).round(3).tolist(), "x") for i in range(230)] + [(230 + i, [0.5] * 8, "x") for i in range(30)]
    rows += [(300, None, "x"), (400, [1.0, None] * 4, "x"), (500, [float("nan")] * 8, "x"), (None, [1.0] * 8, "x")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    got = {tuple(r) for r in topk.top_k(frame, F.col("vec_id") % 100 == 0).collect()}
    ids = np.arange(260)
    m = np.floor(1024 * np.array([r[1] for r in rows[:260]], np.float32).astype(np.float64))
    want = set()
    for q in (0, 100, 200):
        order = [j for j in np.lexsort((ids, -(m @ m[q]))) if j != q][:10]
        want |= {(q, k + 1, int(j), int(m[j] @ m[q])) for k, j in enumerate(order)}
    assert got == want
    assert topk.top_k(frame.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0, 3.0]), (100, [])], "vec_id long, embedding array<float>")
    assert len(topk.top_k(few, F.col("vec_id") % 100 == 0).collect()) == 4


def test_archives_round_trip(spark):
    page = "<p>" + "é" * 600
    rows = [(1, "u", page, 1), (2, "v v", page, 1), (3, None, "x", 1), (4, "w", "x", 1), (5, "w", None, 1), (None, "w", page, 1), (2, "v v", page, 1)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, record_type int")
    got = warc.archived(frame).select("page_id", "payload_bytes", "record_type", "refers_to").collect()
    n = len(page.encode())
    want = [(1, n, "revisit", 2), (2, n, "response", None), (2, n, "response", None), (3, 1, "response", None), (4, 1, "response", None),
            (5, 0, "response", None), (None, n, "response", None)]
    assert Counter(map(tuple, got)) == Counter(want)
    assert warc.archived(frame.limit(0)).count() == 0


@pytest.mark.parametrize("packed", [True, False])
def test_reader_salvages_after_damage(packed):
    blocks = [f"page {i} ".encode() * 40 for i in range(5)]
    parts = [warc.record(i, "u", b, hashlib.sha1(b).hexdigest(), len(b), None) for i, b in enumerate(blocks)]
    parts = [warc.member(p) for p in parts] if packed else parts
    bad = bytearray(b"".join(parts))
    at = len(parts[0])
    bad[at + len(parts[1]) // 2] ^= 0xFF  # inside the second record
    bad += parts[0][: len(parts[0]) // 2]  # cut off at the end
    found = list(warc.salvage(bytes(bad)))
    assert [x[2]["page_id"] for x in found if x[0] == "record"] == [0, 2, 3, 4]
    gaps = [(x[1], x[2][0]) for x in found if x[0] == "gap"]
    assert gaps == [(at, at + len(parts[1])), (sum(map(len, parts)), len(bad))]
    assert list(warc.salvage(b"")) == [] and list(warc.salvage(b"junk"))[0][2][0] == 4


@pytest.mark.parametrize("packed", [True, False])
def test_records_around_a_bad_one_in_a_member_are_kept(packed):
    blocks = [f"page {i} ".encode() * 40 for i in range(4)]
    parts = [bytearray(warc.record(i, "u", b, hashlib.sha1(b).hexdigest(), len(b), None)) for i, b in enumerate(blocks)]
    cut = len(parts[0])
    parts[1][-20] ^= 1  # the payload no longer has its digest
    body = bytes(b"".join(parts))
    after = warc.member(bytes(warc.record(9, "u", b"x", hashlib.sha1(b"x").hexdigest(), 1, None)))
    data = warc.member(body) + after if packed else body
    found = list(warc.salvage(data))
    assert [x[2]["page_id"] for x in found if x[0] == "record"] == ([0, 2, 3, 9] if packed else [0, 2, 3])
    ((_, start, (end, reason)),) = [x for x in found if x[0] == "gap"]
    if packed:
        assert (start, end) == (0, len(warc.member(body))) and f"bytes {cut} to {cut + len(parts[1])}" in reason
        # A member that breaks off: what is whole in front of the break is kept, and what comes behind.
        broken = warc.member(bytes(b"".join([parts[0], parts[2], *[bytes(np.random.default_rng(1).integers(0, 256, 90_000, np.uint8))]])))[:40_000] + after
        found = list(warc.salvage(broken))
        assert [x[2]["page_id"] for x in found if x[0] == "record"] == [0, 2, 9] and [x[1] for x in found if x[0] == "gap"] == [0]
    else:
        assert (start, end) == (cut, cut + len(parts[1]))


def test_archives_are_cut_by_bytes(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(warc, "BLOCK", 4096)
    monkeypatch.setattr(warc, "ARCHIVE_BLOCKS", 4)
    rng = random.Random(5)
    text = lambda n: "".join(chr(rng.randrange(32, 127)) for _ in range(n))
    pages = [(i, "u", text(100)) for i in range(300)] + [(400 + i, "u", text(60_000)) for i in range(3)] + [(500 + i, "u", text(100)) for i in range(50)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1)
    warc.write_warc(frame, f"{tmp_path}/w")
    sizes = sorted(f.stat().st_size for f in (tmp_path / "w").iterdir() if f.name.startswith("part-"))
    assert len(sizes) >= 6 and sizes[-1] < 4 * 4200 + 60_000 and sizes[-4] < 4 * 4600
    got = warc.read_records(spark, f"{tmp_path}/w").collect()
    assert Counter((r.page_id, bytes(r.payload).decode()) for r in got) == Counter((i, t) for i, _, t in pages)
    assert warc.read_gaps(spark, f"{tmp_path}/w").count() == 0


def test_pages_with_long_urls_are_read_back(spark):
    urls = ["data:text/html," + "q" * 150_000, "http://x/" + " \n" * 60_000, "u"]
    frame = spark.createDataFrame([(i, u, f"page {i}") for i, u in enumerate(urls)], "page_id long, url string, html string")
    got = {r.page_id: (r.uri, bytes(r.payload)) for r in warc.archived(frame).collect()}
    assert got == {i: (u.replace(" ", "%20").replace("\n", "%0A"), f"page {i}".encode()) for i, u in enumerate(urls)}


def test_long_headers_are_read_after_damage():
    parts = [warc.record(i, "u" * 120_000, b"x", hashlib.sha1(b"x").hexdigest(), 1, None) for i in range(4)]
    cut = parts[1][: len(parts[1]) // 2]
    found = list(warc.salvage(parts[0] + b"X: WARC/1.1\r\n" * 20_000 + cut + parts[2] + b"WARC/1.1\r\nX: y\r\nbad\r\n" + parts[3] + b"WARC/1.1\r\nX: y\r\n"))
    assert [x[2]["page_id"] for x in found if x[0] == "record"] == [0, 2, 3]


def test_turns_read_back_whatever_they_say():
    rng = random.Random(7)
    pieces = ["\\", "### ", "</turn>", ":", ": ", "=", "\n", "Assistant", "é", "#", " "]
    for _ in range(3000):
        turns = [(rng.choice(["user", "assistant", "system", "", "tool: x", "".join(rng.choices(pieces, k=4))]), "".join(rng.choices(pieces, k=rng.randint(0, 9))))
                 for _ in range(3)]
        text = "".join(chat_format.format_turn(*t)[0] for t in turns)
        assert list(chat_format.read_turns(text)) == turns


def test_layouts_become_the_same_turns(spark):
    records = [
        '{"prompt": "p", "completion": "c"}', '{"messages": [{"role": "user", "content": "p"}, {"role": "assistant", "content": "c"}]}',
        '{"conversations": [{"from": "human", "value": "p"}, {"from": "gpt", "value": "c"}]}', '{"instruction": "p", "input": null, "output": "c"}',
    ]
    frame = spark.createDataFrame([(i, 0, r, 1) for i, r in enumerate(records)] + [(9, 0, "{bad", 1), (9, 1, None, 1)], "conv_id long, place int, record string, role int")
    turns = chat_format.format_records(frame)
    assert turns.where("role IS NULL").count() == 2
    got = chat_format.read_back(turns).collect()
    assert len({r.turns_sha256 for r in got if r.conv_id != 9}) == 1 and {r.n_turns for r in got} == {0, 2}
    assert {r.loss_sha256 for r in got if r.conv_id != 9} == {hashlib.sha256(b"c").hexdigest()}


def test_licenses_are_found_where_they_are(spark, docs):
    text = "Éa. Released  under the MIT\nLicense. more words. This work is licensed under the GNU General Public License, version 3. ok"
    near = "licensed under the Apache big License, Version 2.0"
    frame = spark.createDataFrame([(1, text, 0), (2, near, 0), (2, near, 0), (3, None, 0), (None, "Licensed under CC BY-NC 4.0.", 0)], "doc_id long, text string, coverage int")
    got = license_scan.scan(frame).collect()
    assert Counter((r.doc_id, r.license) for r in got) == Counter([(1, "MIT"), (1, "GPL-3.0"), (2, "Apache-2.0"), (2, "Apache-2.0"), (None, "CC-BY-NC-4.0")])
    mit = next(r for r in got if r.license == "MIT")
    assert text.encode()[mit.start_byte : mit.end_byte].decode() == "Released  under the MIT\nLicense" and mit.coverage == 1.0
    assert license_scan.scan(docs).count() == 0


def test_pipeline_stages_agree_with_their_rules(spark, docs, tmp_path):
    labels = [(i, int(i == 3)) for i in range(18)]
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    table = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = table
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, str(tmp_path))
        assert kept.columns == table.columns, name
        path = f"{tmp_path}/{name}"
        kept.write.parquet(path)
        kept = spark.read.parquet(path)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == kept.count()


def test_near_copy_stage_keeps_the_first_of_what_five_words_at_four_fifths_link(spark):
    rng = random.Random(8)
    texts = []
    for g in range(4):
        base = [f"w{g}x{rng.randrange(10**6)}" for _ in range(200)]
        texts.append(base)
        # Three changed words pass 0.9 on three words, four only 0.8 on five, six neither.
        for changed in (3, 4, 6):
            words = list(base)
            for at in range(changed):
                words[15 + 30 * at] = f"y{rng.randrange(10**9)}"
            texts.append(words)
    texts += [["a", "b", "c"], ["A", "b", "c"], ["a", "b"], []]

    def first_of_each(n, percent):
        sets = [{tuple(x.lower() for x in w[i : i + n]) for i in range(len(w) - n + 1)} or ({tuple(x.lower() for x in w)} if w else set()) for w in texts]
        least = list(range(len(sets)))
        for _ in sets:
            for i, a in enumerate(sets):
                for j, b in enumerate(sets):
                    if a & b and 100 * len(a & b) >= percent * len(a | b):
                        least[i] = least[j] = min(least[i], least[j])
        return set(least)

    frame = spark.createDataFrame([(i, " ".join(w), i) for i, w in enumerate(texts)], "doc_id long, text string, n_chars int")
    kept = corpus_pipeline.drop_near_copies(spark, frame, "")
    assert kept.columns == frame.columns
    assert {r.doc_id for r in kept.collect()} == first_of_each(5, 80) < first_of_each(3, 90)


def test_texts_with_equal_checksums_stay_apart(spark):
    seen, pair = {}, None
    for i in range(10**6):
        text = " ".join(hashlib.md5(f"{i} {k}".encode()).hexdigest()[:9] for k in range(12))
        if pair := seen.setdefault(zlib.crc32(text.encode()), text) != text and (seen[zlib.crc32(text.encode())], text):
            break
    frame = spark.createDataFrame([(d, t) for d in (None, 7) for t in pair], "doc_id long, text string")
    # The null id comes last, so its texts repeat those of id 7.
    assert sorted(r.text for r in ngram_join.one_of_each(frame).collect()) == sorted(pair)
    assert Counter(map(tuple, ngram_join.similar_components(frame).collect())) == Counter({(7, 10, 7): 2, (None, 10, 7): 2})
    got = suffix_dedup.without_repeats(frame)
    assert Counter(map(tuple, got.collect())) == Counter({(7, pair[0]): 1, (7, pair[1]): 1, (None, ""): 2})


def test_empty_tables_give_empty_results(docs):
    none = docs.limit(0)
    assert suffix_dedup.remove_repeats(none).count() == 0
    assert ngram_join.similar_components(none).count() == 0
    assert mixing.mix(none).count() == 0
    assert line_quality.line_verdicts(none).count() == 0
    assert license_scan.scan(none).count() == 0


def test_a_written_step_leaves_no_shuffle_files(spark, tmp_dir):
    from pyspark.sql import functions as F

    from orderlake.llm.cleanup import write_and_drop_shuffles

    held = lambda: spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().size()
    rows = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    before = held()
    write_and_drop_shuffles(rows, f"{tmp_dir}/kept")
    assert held() <= before and spark.read.parquet(f"{tmp_dir}/kept").count() == 7
