"""Secrets: patterns against plain regular expressions, the random field against enumeration and held-out rows."""

import hashlib
import itertools
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from orderlake.llm import secret_scan as S
from orderlake.llm._arrays import text_buffer

PATTERNS = {
    "assign": (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 8),
    "access": (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16),
    "hex": (r"[0-9a-f]+", lambda m: len(m[0]) >= 32),
}
HEX = "0123456789abcdef"
WORDS = ["the", "of", "Sea", "hill", "étang", "dead", "beef", "a1", "2024", "x@y.zz", "4111111111111111", "long-word_here"]


def brute_force(text):
    spans = [(m.start(), k, m.end()) for k, (p, ok) in enumerate(PATTERNS.values()) for m in re.finditer(p, text or "", re.ASCII) if ok(m)]
    return [f"{list(PATTERNS)[k]}:{a}:{b}" for a, k, b in sorted(spans)]


def _texts():
    rng = random.Random(2)
    h = lambda n: "".join(rng.choice(HEX) for _ in range(n))
    out = [None, "", "\n", "é" * 50, "a" * 31, "é" + "a" * 32, "ab" * 5000, "AKIA" * 6, "xAKIAQQ AKIA" + "Z9" * 8, 'password="secret":longvalue123', "TOKEN = 'short' token=abcdefgh",
           "ToKeN:" + h(40), "Kecret=abcdefghij ſecret=abcdefghij toKen=abcdefghij", "api_key=a=b=c=d=e", "passwd" * 9 + "=" + "x" * 9, "secret\t=\tabcdefghij", "token=\n" + h(40)]
    for _ in range(300):
        pieces = [rng.choice(WORDS) for _ in range(rng.randint(3, 60))]
        for _ in range(rng.randint(0, 2)):
            new = rng.choice([f'token = "{h(40)}"', f"password={h(rng.randint(5, 18))}", "AKIA" + "".join(rng.choice("ABCXYZ0189") for _ in range(rng.choice([5, 16]))), h(rng.choice([31, 32, 64])), "Api_Key: 'ab/cd+ef_9.x='"])
            pieces.insert(rng.randint(0, len(pieces)), new)
        out.append(rng.choice([" ", "  ", "\n"]).join(pieces))
    return out


def test_patterns_equal_regular_expressions(spark):
    texts = _texts()
    frame = spark.createDataFrame([(i % 9 or None, t, "s", 1) for i, t in enumerate(texts)] + [(5, texts[-1], "s", 1)] * 2, "doc_id long, text string, spans string, n_hex int")
    got = S.scan(frame, S.Field()).collect()
    want = Counter()
    for i, t in [*enumerate(texts), (5, texts[-1]), (5, texts[-1])]:
        spans = brute_force(t)
        kinds = Counter(s.split(":")[0] for s in spans)
        want[(i % 9 or None, kinds["assign"], kinds["access"], kinds["hex"], hashlib.sha256(",".join(spans).encode()).hexdigest(), ",".join(spans), 0)] += 1
    assert Counter(map(tuple, got)) == want and sum(bool(brute_force(t)) for t in texts) > 100
    assert S.scan(frame.limit(0), S.Field()).count() == 0


def _random_field(seed):
    rng = np.random.default_rng(seed)
    field = S.Field()
    field.move, field.first, field.last = rng.normal(0, 1.5, (3, 3)).astype(np.float32), rng.normal(0, 1, 3).astype(np.float32), rng.normal(0, 1, 3).astype(np.float32)
    return field, rng


def _paths(field, score):
    for tags in itertools.product(range(3), repeat=len(score)):
        yield float(field.first[tags[0]] + field.last[tags[-1]] + sum(score[i, y] for i, y in enumerate(tags)) + sum(field.move[a, b] for a, b in zip(tags, tags[1:]))), tags


def test_decoding_finds_the_best_of_all_paths():
    for seed in range(40):
        field, rng = _random_field(seed)
        lengths = rng.integers(1, 8, 6)
        score = rng.normal(0, 2, (int(lengths.sum()), 3))
        score[:, S.O] += rng.choice([0, 4, 9], len(score))  # some tokens are surely outside
        chain = np.repeat(np.arange(len(lengths)), lengths)
        got = S.decode(field, score, chain)
        for c in range(len(lengths)):
            best, tags = max(_paths(field, score[chain == c]))
            assert tuple(got[chain == c]) == tags
    assert S.surely_outside(field, score, chain).any()


def test_likelihood_and_gradient_equal_enumeration():
    field, rng = _random_field(7)
    lengths = np.array([4, 1, 3])
    begin, n = np.array([0, 4, 5]), 8
    score, tags = rng.normal(0, 1, (n, 3)), rng.integers(0, 3, n)

    def likelihood():
        total = 0.0
        for b, size in zip(begin, lengths):
            paths = list(_paths(field, score[b : b + size]))
            total += next(s for s, t in paths if t == tuple(tags[b : b + size])) - np.log(sum(np.exp(s) for s, _ in paths))
        return total

    value, d, d_move, d_first, d_last = S.gradients(field, score, begin, lengths, tags)
    assert value * 3 == pytest.approx(likelihood(), rel=1e-4)
    for array, grad, at in ((score, d, (2, 1)), (score, d, (4, 0)), (field.move, d_move, (1, 2)), (field.first, d_first, (0,)), (field.last, d_last, (2,))):
        old = array[at]
        array[at] = old + 1e-2
        up = likelihood()
        array[at] = old - 1e-2
        down = likelihood()
        array[at] = old
        assert (up - down) / 2e-2 == pytest.approx(grad[at], rel=0.02, abs=2e-3)


def test_tokens_cover_all_but_white_space():
    texts = ["ab=c_d é+x\n 9\x0b\x0c(:", "", None, "zz", "y"]
    raw, offs = text_buffer(pa.array(texts, pa.string()))
    t = S.tokens_of(raw, offs)
    assert [raw[a:b].tobytes().decode() for a, b in zip(t.start, t.end)] == ["ab", "=", "c_d", "é+x", "9", "(", ":", "zz", "y"]
    assert t.chain.tolist() == [0, 0, 0, 0, 1, 1, 1, 2, 3] and t.row.tolist() == [0] * 7 + [3, 4]


def test_the_field_finds_held_out_secrets_and_leaves_prose_alone(spark):
    rng = random.Random(8)

    def text(secret=None):
        words = [rng.choice(WORDS[:5] + ["morning", "Bridge", "2024", "a@b.cc"]) for _ in range(120)]
        if secret:
            words.insert(60, secret)
        return " ".join(words)

    value = lambda n: "".join(rng.choice(HEX) for _ in range(n))
    rows = [(i, text([f'token = "{value(40)}"', f"password={value(18)}", "AKIA" + value(16).upper(), None][i % 4])) for i in range(400)]
    new = [(1000 + i, text(f'credential "{value(24)}"' if i % 2 else None)) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    field = S.train(docs, 150)
    raw, offs = text_buffer(pa.array([t for _, t in new], pa.string()))
    found = S.added_spans(field, raw, offs, {})
    assert all(i % 2 for i in found) and len(found) >= 60
    for row, spans in found.items():
        ((a, _, b),) = spans
        assert new[row][1][a:b] in new[row][1].split('"')[1]
    got = {r.doc_id: r for r in S.scan(spark.createDataFrame(new, "doc_id long, text string"), field).collect()}
    assert sum(r.n_added for r in got.values()) == len(found) and all(r.spans.startswith("crf:") for r in got.values() if r.n_added)
    # The patterns' spans stay, and the field's never touch them.
    for r in S.scan(docs, field).collect():
        assert ",".join(x for x in r.spans.split(",") if not x.startswith("crf")) == ",".join(brute_force(rows[r.doc_id][1]))


def test_training_is_repeatable_and_needs_secrets(spark):
    docs = spark.createDataFrame([(1, "nothing here"), (2, None), (2, None)], "doc_id long, text string")
    assert S.train(docs).blank and S.train(docs.limit(0)).blank
    texts = ["a token = abcdef123456 b", "plain words"] * 3
    one, two = S.fit(texts), S.fit(texts)
    assert all((x == y).all() for x, y in zip(one.weights(), two.weights()))


def test_the_sample_is_bounded_and_follows_the_texts(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choice(WORDS) for _ in range(8)) + f" {i}" for i in range(900)]
    texts += [f"{t} token = {i:040x}" for i, t in enumerate(texts[:300])]
    rows = [(i, t) for i, t in enumerate(texts)] + [(2000 + i, "the same again") for i in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = S.sample(docs.repartition(7), 40)
    hits = [t for t in got if "token" in t]
    assert len(got) == 80 and len(hits) == 40 and len(set(got)) == 80
    assert got == S.sample(docs.repartition(3), 40)
    everything = S.sample(docs, 5000)
    assert sorted(everything) == sorted(set(t for _, t in rows))
