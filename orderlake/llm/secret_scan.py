"""Secrets in texts: fixed patterns, and a linear-chain conditional random field that adds to them.

A text is cut into tokens: runs of letters, digits and ``+/_-``, and single other characters. A line is a chain.
The field gives every token one of the tags *outside*, *begin* and *inside* from its shape (length, characters,
changes between kinds of characters), the shapes and hashed words of its neighbours, and features of the whole text.
It is trained in numpy on the whole texts of a bounded sample of rows, in which the patterns' matches stand for
secrets; while it learns, neighbouring words are hidden at random and values are rewritten with other characters, so that it
finds secrets that the patterns miss.

Decoding is exact Viterbi. Before it, tokens whose lead of *outside* no neighbour's tag could make up for are fixed, in a
few rounds, each with the bounds that the tags left to the neighbours allow. The best path has the same tags there, and
what is left are short chains that numpy decodes side by side.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlake.llm._arrays import PAD, U64, lower_ascii, mix, part_slices, text_buffer, tidy

# Fixed values of the rule: kinds in their order, patterns, least lengths.
KINDS = ("assign", "access", "hex", "crf")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ASSIGN_LEAST = 8
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LEAST = 16
HEX_LEAST = 32
_KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

#: Rows with and without a match of the patterns that training reads, at most, of each.
MAX_ROWS = 600
EPOCHS = 12
#: Times that a text with secrets is read again with other values.
REWRITTEN = 3
O, B, I = 0, 1, 2  # noqa: E741
SLICE = 1 << 21

# Kinds of bytes: white space, token characters, single characters.
_KIND = np.full(256, 2, np.uint8)
_KIND[[0x20, *range(0x09, 0x0E)]] = 0
_KIND[[*range(48, 58), *range(65, 91), *range(97, 123), *b"+/_-", *range(128, 256)]] = 1
_DIGIT, _UPPER, _LOWER, _AF, _SIGN, _WIDE = (np.zeros(256, np.int32) for _ in range(6))
_DIGIT[48:58], _UPPER[65:91], _LOWER[97:123], _AF[97:103], _WIDE[128:] = 1, 1, 1, 1, 1
_SIGN[list(b"+/_-")] = 1
_SORT = (_DIGIT + 2 * _UPPER + 3 * _LOWER + 4 * _SIGN + 5 * _WIDE).astype(np.uint8)
_HEX = (_DIGIT + _AF) > 0
_LENGTHS = np.array([2, 3, 4, 6, 8, 12, 16, 20, 28, 36, 48])
_CHANGES = np.array([0.15, 0.4])
_N_SORT = 12
_WORD_SHAPES = (len(_LENGTHS) + 1) * _N_SORT * 3
SHAPES = _WORD_SHAPES + 256  # and one more for "no neighbour"
WORDS = 1 << 12
FILES = (8, 8, 24)
#: Offsets of the neighbours whose shapes and whose words are features.
SHAPE_AT, WORD_AT = (0, -1, -2, 1), (-1, -2, -3)


def _edges(inside: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of set bytes; a row's end ends a run."""
    solid = np.zeros(len(inside) + 2, bool)
    solid[1:-1] = inside
    edge = np.flatnonzero(solid[1:] != solid[:-1])
    cuts = np.unique(offs[1:-1])
    cuts = cuts[(cuts > 0) & (cuts < len(inside))]
    cuts = cuts[solid[cuts] & solid[cuts + 1]]
    return np.sort(np.append(edge[::2], cuts)), np.sort(np.append(edge[1::2], cuts))


def base_spans(raw: np.ndarray, offs: np.ndarray) -> dict[int, list[tuple[int, int, int, int]]]:
    """Of each row with a match of a pattern: (start, kind, end, start of the secret itself), in code points."""
    found: dict[int, list[tuple[int, int, int, int]]] = {}
    data = raw.tobytes()
    low = lower_ascii(raw).tobytes()

    def rows_with(text: bytes, needle: bytes) -> Iterator[int]:
        at = text.find(needle)
        while at >= 0:
            row = int(np.searchsorted(offs, at, side="right")) - 1
            yield row
            at = text.find(needle, int(offs[row + 1]))  # once per row is enough

    def text_of(row: int) -> str:
        return data[offs[row] : offs[row + 1]].decode("utf-8", "replace")

    for row in {r for word in _KEYWORDS for r in rows_with(low, word)}:
        spans = [(m.start(), 0, m.end(), m.start(2)) for m in ASSIGN.finditer(text_of(row)) if len(m[2]) >= ASSIGN_LEAST]
        if spans:
            found.setdefault(row, []).extend(spans)
    for row in set(rows_with(data, b"AKIA")):
        spans = [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(text_of(row)) if len(m[0]) >= ACCESS_LEAST]
        if spans:
            found.setdefault(row, []).extend(spans)
    start, end = _edges(_HEX[raw], offs)
    long = np.flatnonzero(end - start >= HEX_LEAST)
    for a, b in zip(start[long].tolist(), end[long].tolist()):
        row = int(np.searchsorted(offs, a, side="right")) - 1
        at = _points(raw, int(offs[row]), np.array([a]))[0]
        found.setdefault(row, []).append((int(at), 2, int(at) + b - a, int(at)))
    return {row: sorted(spans) for row, spans in found.items()}


def _points(raw: np.ndarray, first: int, at: np.ndarray) -> np.ndarray:
    """Code points between a row's first byte and byte places in it."""
    if not len(at):
        return at
    begins = np.append(0, np.cumsum((raw[first : int(at.max())] & 0xC0) != 0x80))
    return begins[at - first]


@dataclass
class Tokens:
    """Tokens of some texts with the numbers of their features; ``chain`` tells lines apart."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    chain: np.ndarray
    shape: np.ndarray
    word: np.ndarray
    file: np.ndarray  # (rows, features)


def tokens_of(raw: np.ndarray, offs: np.ndarray) -> Tokens:
    rows = len(offs) - 1
    kind = _KIND[raw]
    start, end = _edges(kind == 1, offs)
    single = np.flatnonzero(kind == 2)
    start = np.append(start, single)
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.append(end, single + 1)[order]
    row = np.searchsorted(offs, start, side="right") - 1
    lines = np.flatnonzero(raw == 10)
    line = np.searchsorted(lines, start)
    if not len(start):
        z = np.zeros(0, np.int64)
        return Tokens(z, z, z, z, z, z, np.zeros((rows, len(FILES)), np.int64))
    new = np.ones(len(start), bool)
    new[1:] = (row[1:] != row[:-1]) | (line[1:] != line[:-1])
    # White space adds nothing to these sums, so a token's sum may run up to the next one.
    size = end - start
    total = lambda table: np.add.reduceat(table[raw], start)
    digit, upper, lower, af, sign, wide = map(total, (_DIGIT, _UPPER, _LOWER, _AF, _SIGN, _WIDE))
    sorts = _SORT[raw]
    change = np.zeros(len(raw), np.int32)
    change[1:] = (sorts[1:] != sorts[:-1]) & (sorts[1:] > 0) & (sorts[:-1] > 0)
    changes = np.add.reduceat(change, start) - change[start]
    title = (_UPPER[raw[start]] == 1) & (upper == 1)
    conditions = [wide > 0, sign > 0, (digit == size), (lower == size), (upper == size), title & (digit == 0), digit == 0,
                  (digit + af == size), (digit + lower == size), (digit + upper == size)]
    sort = np.select(conditions, range(10), 10)
    shape = ((np.searchsorted(_LENGTHS, size, side="right") * _N_SORT + sort) * 3 + np.searchsorted(_CHANGES, changes / size)).astype(np.int64)
    alone = kind[start] == 2
    shape[alone] = _WORD_SHAPES + raw[start[alone]].astype(np.int64)
    # A word is hashed by its first eight bytes and its length.
    buffer = np.zeros(len(raw) + PAD, np.uint8)
    buffer[: len(raw)] = lower_ascii(raw)
    head = np.ndarray(len(raw) + 1, dtype="<u8", buffer=buffer, strides=(1,))[start].astype(U64)
    head &= U64((1 << 64) - 1) >> (U64(64) - U64(8) * np.minimum(size, 8).astype(U64))
    word = (mix(head + U64(0x9E37) * np.minimum(size, 16).astype(U64)) >> U64(40)) % U64(WORDS)
    # Of the whole text: digits per byte, single characters per token, length.
    bytes_, count = np.maximum(np.diff(offs), 1), np.maximum(np.bincount(row, minlength=rows), 1)
    share = lambda x, n: np.minimum(7, np.floor(64 * x / n)).astype(np.int64)
    file = np.stack([share(np.bincount(row, digit, rows), bytes_), share(np.bincount(row, alone, rows), count),
                     np.minimum(FILES[2] - 1, np.floor(np.log2(bytes_))).astype(np.int64)], axis=1)
    return Tokens(start, end, row, np.cumsum(new) - 1, shape, word.astype(np.int64), file)


def _beside(values: np.ndarray, chain: np.ndarray, by: int, none: int) -> np.ndarray:
    """Each token's neighbour's value, ``none`` beyond the line."""
    out = np.full(len(values), none, np.int64)
    if by < 0:
        same = chain[-by:] == chain[:by]
        out[-by:] = np.where(same, values[:by], none)
    else:
        same = chain[:-by] == chain[by:]
        out[:-by] = np.where(same, values[by:], none)
    return out


def features(t: Tokens) -> list[np.ndarray]:
    """For each weight table the entry that each token uses."""
    shapes = [t.shape if by == 0 else _beside(t.shape, t.chain, by, SHAPES) for by in SHAPE_AT]
    words = [_beside(t.word, t.chain, by, WORDS) for by in WORD_AT]
    return [*shapes, *words, *t.file[t.row].T]


class Field:
    """Weights of the random field: a table per feature, transitions, and scores of a line's first and last tag."""

    def __init__(self) -> None:
        sizes = [SHAPES + 1] * len(SHAPE_AT) + [WORDS + 1] * len(WORD_AT) + list(FILES)
        self.tables = [np.zeros((n, 3), np.float32) for n in sizes]
        self.move = np.zeros((3, 3), np.float32)
        self.first, self.last = np.zeros(3, np.float32), np.zeros(3, np.float32)
        self.blank = True

    def emissions(self, found: list[np.ndarray]) -> np.ndarray:
        out = self.tables[0][found[0]]
        for table, x in zip(self.tables[1:], found[1:]):
            out += table[x]
        return out

    def weights(self) -> list[np.ndarray]:
        return [*self.tables, self.move, self.first, self.last]


def _packed(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chains by falling length, and how many are longer than j for each j."""
    order = np.argsort(-lengths, kind="stable")
    longest = int(lengths[order[0]]) if len(order) else 0
    return order, np.searchsorted(-lengths[order], -np.arange(longest), side="left")


def gradients(field: Field, score: np.ndarray, begin: np.ndarray, lengths: np.ndarray, tags: np.ndarray):
    """Log likelihood of the tags, and its gradient by emission and by transition, first and last score.

    Chains are handled side by side, one place after the other (forward-backward, scaled at each place).
    """
    order, alive = _packed(lengths)
    begin, lengths = begin[order], lengths[order]
    n = len(begin)
    peak = score.max(axis=1, keepdims=True)
    gain = np.exp(score - peak)
    step = np.exp(field.move.astype(np.float64))
    ahead = np.zeros((len(score), 3))
    scale = np.zeros(len(score))
    now = np.exp(field.first.astype(np.float64)) * gain[begin]
    for j, m in enumerate(alive):
        at = begin[:m] + j
        if j:
            now = now[:m] @ step * gain[at]
        scale[at] = now.sum(axis=1)
        now = now / scale[at][:, None]
        ahead[at] = now
    ends = begin + lengths - 1
    out = np.exp(field.last.astype(np.float64))
    z = ahead[ends] @ out
    likelihood = -(np.log(scale).sum() + peak.sum() + np.log(z).sum())
    back = np.zeros((len(score), 3))
    back[ends] = out / z[:, None]
    pairs = np.zeros((3, 3))
    for j in range(len(alive) - 1, 0, -1):
        m = alive[j]
        at = begin[:m] + j
        flow = gain[at] * back[at] / scale[at][:, None]
        pairs += ahead[at - 1].T @ flow
        back[at - 1] = flow @ step.T
    pairs *= step
    belief = ahead * back
    likelihood += score[np.arange(len(score)), tags].sum() + field.first[tags[begin]].sum() + field.last[tags[ends]].sum()
    inner = np.ones(len(score), bool)
    inner[begin] = False
    likelihood += field.move[tags[np.flatnonzero(inner) - 1], tags[inner]].sum()
    d = -belief
    d[np.arange(len(score)), tags] += 1
    seen = np.zeros((3, 3))
    np.add.at(seen, (tags[np.flatnonzero(inner) - 1], tags[inner]), 1)
    d_first = np.bincount(tags[begin], minlength=3) - belief[begin].sum(axis=0)
    d_last = np.bincount(tags[ends], minlength=3) - belief[ends].sum(axis=0)
    return likelihood / max(n, 1), d, seen - pairs, d_first, d_last


def viterbi(field: Field, score: np.ndarray, begin: np.ndarray, lengths: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Tags of the best path of each chain; ``first`` and ``last`` are scores of its ends, per chain."""
    tags = np.zeros(len(score), np.int8)
    if not len(begin):
        return tags
    order, alive = _packed(lengths)
    begin, lengths, first, last = begin[order], lengths[order], first[order], last[order]
    link = np.zeros((len(score), 3), np.int8)
    best = first + score[begin]
    final = best.copy()
    for j, m in enumerate(alive):
        if not j:
            continue
        at = begin[:m] + j
        ways = best[:m, :, None] + field.move
        link[at] = ways.argmax(axis=1)
        best = ways.max(axis=1) + score[at]
        final[:m] = best
    now = (final + last).argmax(axis=1).astype(np.int8)
    tags[begin + lengths - 1] = now
    for j in range(len(alive) - 1, 0, -1):
        m = alive[j]
        at = begin[:m] + j
        tags[at - 1] = link[at, tags[at]]
    return tags


def surely_outside(field: Field, score: np.ndarray, chain: np.ndarray, rounds: int = 4) -> np.ndarray:
    """Tokens that are outside on every best path: no tag of a neighbour could make up for the lead."""
    n = len(score)
    sure = np.zeros(n, bool)
    head = np.append(True, chain[1:] != chain[:-1])
    tail = np.append(head[1:], True)
    move = field.move.astype(np.float64)
    # What a tag gains over "outside" from the tag before it: any, "outside", or the line's start.
    before = {"any": (move - move[:, [O]]).max(axis=0), "sure": move[O] - move[O, O], "end": field.first - field.first[O]}
    after = {"any": (move - move[[O], :]).max(axis=1), "sure": move[:, O] - move[O, O], "end": field.last - field.last[O]}
    lead = score[:, [O]] - score[:, [B, I]]
    for _ in range(rounds):
        left, right = np.append(False, sure[:-1]), np.append(sure[1:], False)
        gain = np.where(head[:, None], before["end"][1:], np.where(left[:, None], before["sure"][1:], before["any"][1:]))
        gain = gain + np.where(tail[:, None], after["end"][1:], np.where(right[:, None], after["sure"][1:], after["any"][1:]))
        now = (lead > gain + 1e-3).all(axis=1)
        if (now == sure).all():
            break
        sure = now
    return sure


def decode(field: Field, score: np.ndarray, chain: np.ndarray) -> np.ndarray:
    """The best tags of all lines."""
    tags = np.zeros(len(score), np.int8)
    if not len(score):
        return tags
    sure = surely_outside(field, score, chain)
    rest = np.flatnonzero(~sure)
    if not len(rest):
        return tags
    cut = np.append(True, (np.diff(rest) > 1) | (np.diff(chain[rest]) > 0))
    begin = np.flatnonzero(cut)
    lengths = np.diff(np.append(begin, len(rest)))
    a, b = rest[begin], rest[begin + lengths - 1]
    head = np.append(True, chain[1:] != chain[:-1])[a]
    tail = np.append(chain[1:] != chain[:-1], True)[b]
    first = np.where(head[:, None], field.first, field.move[O])
    last = np.where(tail[:, None], field.last, field.move[:, O])
    tags[rest] = viterbi(field, score[rest], begin, lengths, first, last)
    return tags


def secrets_of(spans: list[tuple[int, int, int, int]]) -> list[tuple[int, int]]:
    """Starts and ends of the secrets themselves, without the names that they are assigned to; none overlaps another."""
    out: list[tuple[int, int]] = []
    for start, end in sorted({(s[3], s[2]) for s in spans}):
        if out and start < out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


#: Characters of the values that stand in for found ones while the field learns.
_ALPHABETS = ["0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "abcdefghijklmnopqrstuvwxyz0123456789"]


def rewritten(text: str, secrets: list[tuple[int, int]], rng: np.random.Generator) -> tuple[str, list[tuple[int, int]]]:
    """The text with random values in place of its secrets, and where these lie."""
    pieces, spans, at, size = [], [], 0, 0
    for start, end in secrets:
        letters = _ALPHABETS[rng.integers(len(_ALPHABETS))]
        value = "".join(letters[k] for k in rng.integers(0, len(letters), rng.integers(14, 45)))
        pieces += [text[at:start], value]
        size += start - at
        spans.append((size, size + len(value)))
        size += len(value)
        at = end
    return "".join([*pieces, text[at:]]), spans


def tags_of(raw: np.ndarray, offs: np.ndarray, t: Tokens, secrets: dict[int, list[tuple[int, int]]]) -> np.ndarray:
    """Training tags: each secret's first token begins it, the others lie inside."""
    tags = np.zeros(len(t.start), np.int64)
    for row, spans in secrets.items():
        a, b = np.searchsorted(t.row, [row, row + 1])
        at = _points(raw, int(offs[row]), t.start[a:b])
        for start, end in spans:
            x, y = np.searchsorted(at, [start, end]) + a
            tags[x:y] = I
            tags[x : min(x + 1, y)] = B
    return tags


def fit(texts: list[str], epochs: int = EPOCHS, batch: int = 256, seed: int = 11, hide: float = 0.3) -> Field:
    """Train on whole texts, those with secrets again with other values; without a secret nothing is ever tagged."""
    field = Field()
    rng = np.random.default_rng(seed)
    secrets = {row: secrets_of(spans) for row, spans in sorted(base_spans(*text_buffer(pa.array(texts, pa.string()))).items())}
    texts = list(texts)
    for row, spans in list(secrets.items()) * REWRITTEN:
        text, secrets[len(texts)] = rewritten(texts[row], spans, rng)
        texts.append(text)
    raw, offs = text_buffer(pa.array(texts, pa.string()))
    t = tokens_of(raw, offs)
    tags = tags_of(raw, offs, t, secrets)
    if not (tags > 0).any():
        return field
    field.blank = False
    found = features(t)
    begin = np.flatnonzero(np.append(True, t.chain[1:] != t.chain[:-1]))
    lengths = np.diff(np.append(begin, len(t.start)))
    weights = field.weights()
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
    step = 0
    # Lines of like lengths go together; the order of the batches is drawn anew each time.
    parts = np.array_split(np.argsort(lengths, kind="stable"), max(1, -(-len(lengths) // batch)))
    for epoch in range(epochs):
        rate = 0.1 * (1 - 0.9 * epoch / epochs)
        for k in rng.permutation(len(parts)):
            lines = parts[k]
            size = lengths[lines]
            to = np.cumsum(size) - size
            at = np.repeat(begin[lines] - to, size) + np.arange(int(size.sum()))
            used = [x[at] for x in found]
            for i, by in enumerate(WORD_AT):
                used[len(SHAPE_AT) + i] = np.where(rng.random(len(at)) < hide, WORDS, used[len(SHAPE_AT) + i])
            _, d, *rest = gradients(field, field.emissions(used), to, size, tags[at])
            grads = []
            for table, x in zip(field.tables, used):
                g = np.stack([np.bincount(x, d[:, y], len(table)) for y in range(3)], axis=1)
                grads.append(g)
            step += 1
            for w, g, (m, v) in zip(weights, [*grads, *rest], moments):
                g = (g / len(lines) - 1e-4 * w).astype(np.float32)
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                w += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
    return field


def added_spans(field: Field, raw: np.ndarray, offs: np.ndarray, base: dict[int, list[tuple[int, int, int, int]]]) -> dict[int, list[tuple[int, int, int]]]:
    """Spans that the field tags, have a letter or digit and touch no pattern's match: by row (start, kind, end)."""
    if field.blank:
        return {}
    t = tokens_of(raw, offs)
    tags = decode(field, field.emissions(features(t)), t.chain)
    hit = np.flatnonzero(tags)
    if not len(hit):
        return {}
    begins = np.append(True, (np.diff(hit) > 1) | (np.diff(t.chain[hit]) > 0)) | (tags[hit] == B)
    lead = np.flatnonzero(begins)
    worded = np.maximum.reduceat(t.shape[hit] < _WORD_SHAPES, lead)
    tail = hit[np.append(lead[1:], len(hit)) - 1]
    lead, tail = hit[lead[worded]], tail[worded]
    a, b = t.start[lead], t.end[tail]
    out: dict[int, list[tuple[int, int, int]]] = {}
    rows = t.row[lead]
    for row in np.unique(rows).tolist():
        mine = rows == row
        x, y = _points(raw, int(offs[row]), a[mine]), _points(raw, int(offs[row]), b[mine])
        spans = [(int(s), 3, int(e)) for s, e in zip(x, y) if not any(s < q and p < e for p, _, q, _ in base.get(row, ()))]
        if spans:
            out[row] = spans
    return out


def sample(docs: DataFrame, most: int = MAX_ROWS) -> list[str]:
    """Whole texts for training: ``most`` with a match of the patterns and as many without, or all.

    One pass counts both kinds. The counts give a share of the hash range that holds somewhat more than ``most`` texts of a kind, and
    only rows in it send their texts on, so what moves doesn't grow with the table. Equal texts have one hash and count once.
    """

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits = rows = 0
        for part in parts:
            for texts in part_slices(part, "text", SLICE):
                hits += len(base_spans(*text_buffer(texts["text"])))
                rows += texts.num_rows
        yield pa.RecordBatch.from_arrays([pa.array([hits]), pa.array([rows])], names=["hits", "rows"])

    texts = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    seen = texts.mapInArrow(tidy(count), "hits long, rows long").agg(F.sum("hits").alias("hits"), F.sum("rows").alias("rows")).first()
    hits, rows = seen["hits"] or 0, seen["rows"] or 0
    span = 1 << 40
    wanted = most + 6 * most**0.5
    below = {hit: int(span * min(1.0, wanted / max(n, 1))) for hit, n in ((True, hits), (False, rows - hits))}

    def pick(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[bool, list[tuple[int, str]]] = {True: [], False: []}
        held: set[tuple[bool, int]] = set()
        for part in parts:
            for texts in part_slices(part, "text", SLICE):
                found = base_spans(*text_buffer(texts["text"]))
                for i, h in enumerate(texts["h"].to_pylist()):
                    hit = i in found
                    # A heap by falling hash: the largest of the smallest is on top.
                    heap = best[hit]
                    if h >= below[hit] or (hit, h) in held or (len(heap) == most and -h < heap[0][0]):
                        continue
                    held.add((hit, h))
                    heapq.heappush(heap, (-h, texts["text"][i].as_py()))
                    if len(heap) > most:
                        heapq.heappop(heap)
        rows = [(hit, -h, text) for hit, heap in best.items() for h, text in heap]
        for k in range(0, len(rows), 64):
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows[k : k + 64]), (pa.bool_(), pa.int64(), pa.string()))], names=["hit", "h", "text"])

    hashed = texts.withColumn("h", F.xxhash64("text").bitwiseAND(span - 1)).where(F.col("h") < max(below.values()))
    picked = hashed.mapInArrow(tidy(pick), "hit boolean, h long, text string").groupBy("hit", "h").agg(F.min("text").alias("text"))
    best = Window.partitionBy("hit").orderBy("h")
    taken = picked.withColumn("place", F.row_number().over(best)).where(F.col("place") <= most)
    return [r["text"] for r in taken.orderBy(F.col("hit").desc(), "h").collect()]


def train(docs: DataFrame, most: int = MAX_ROWS) -> Field:
    """A field fitted on a bounded sample of rows."""
    return fit(sample(docs, most))


_OUT = pa.schema([("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("base_sha256", pa.string()),
                  ("spans", pa.string()), ("n_added", pa.int64())])


def _spelled(spans: list) -> str:
    return ",".join(f"{KINDS[s[1]]}:{s[0]}:{s[2]}" for s in sorted(spans, key=lambda s: (s[0], s[1], s[2])))


def scan(docs: DataFrame, field: Field) -> DataFrame:
    """Per row doc_id, n_assign, n_access, n_hex, base_sha256, spans and n_added.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. Spans are kind:start:end in code points, the end
    exclusive, by start and kind, joined by commas; base_sha256 is the digest of those of the patterns alone, and n_added counts
    the field's. Spans of the field that touch one of a pattern are left out. Null and empty texts have no spans. Repeated rows and rows without an id are kept as they
    are; equal texts have equal spans. Empty tables give an empty result. Texts are read whole, a long one as a slice of its own.
    """
    model = docs.sparkSession.sparkContext.broadcast(field)

    def apply(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = hashlib.sha256(b"").hexdigest()
        for part in parts:
            for piece in part_slices(part, "text", SLICE):
                raw, offs = text_buffer(piece["text"])
                base = base_spans(raw, offs)
                more = added_spans(model.value, raw, offs, base)
                n = np.zeros((4, piece.num_rows), np.int64)
                digest, spans = [none] * piece.num_rows, [""] * piece.num_rows
                for row in base.keys() | more.keys():
                    own = base.get(row, [])
                    for s in [*own, *more.get(row, [])]:
                        n[s[1], row] += 1
                    digest[row] = hashlib.sha256(_spelled(own).encode()).hexdigest()
                    spans[row] = _spelled([*own, *more.get(row, [])])
                columns = [piece["doc_id"], *map(pa.array, n[:3]), pa.array(digest), pa.array(spans, pa.string()), pa.array(n[3])]
                yield pa.RecordBatch.from_arrays(columns, schema=_OUT)

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return keyed.mapInArrow(tidy(apply), "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_added long")
