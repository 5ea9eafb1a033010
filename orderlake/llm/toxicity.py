"""Toxicity scores from a bidirectional gated recurrent network with attention pooling.

A window of words is read forwards and backwards by gated recurrent units;
attention weighs the states of its words into one vector, and a logistic unit scores
it. A word enters as a hashed word embedding together with the mean of its hashed
character-gram embeddings. The score of a text is the largest score of its windows: the
windows overlap and cover the whole text.

Training (backpropagation through time, Adam, in numpy) starts on a bounded sample of labelled rows. Where there are more,
it goes on in the tasks over all labelled rows and all their windows: each task trains on its shard, and the shards'
weights are averaged. The cut between the classes then comes from all rows held back for it. Scoring runs in the tasks, over all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.llm._arrays import U64, lower_ascii, mix, release, rolling, row_slices, text_buffer, word_hashes, words_of
from orderlake.llm.cleanup import collect_and_drop_shuffles

WINDOW, STRIDE = 64, 48
HIDDEN, ATTENTION = 8, 8
WORD_SLOTS, WORD_DIM = 1 << 15, 8
CHAR_SLOTS, CHAR_DIM = 1 << 14, 8
CHAR_GRAM = 5
#: Labelled rows of each class, and windows of each of them, that training reads at most.
MAX_ROWS, MAX_WINDOWS = 4000, 8
#: Rows of a shard of the training over all rows, aimed at, and rows of its batches.
SHARD_ROWS, SHARD_BATCH = 5000, 64
#: Weights that are averaged together, and the cut's bins by logit: BINS for each unit, up to LOGIT_MOST.
PIECE = 4096
BINS, LOGIT_MOST = 256, 64
#: Rows whose hash lies above (a fifth) only set the cut. The sample takes the smallest hashes.
HELD_ABOVE = int(0.6 * 2**63)


@dataclass
class Words:
    """The words of a batch of texts: per word its distinct word, and the distinct words' inputs."""

    which: np.ndarray  # distinct word of each word
    word_slot: np.ndarray  # of each distinct word
    char_slot: np.ndarray  # of all character grams of the distinct words
    char_at: np.ndarray  # offsets of the distinct words in char_slot
    windows: np.ndarray  # first word of each window
    length: np.ndarray  # words of each window
    row: np.ndarray  # text of each window


def featurize(column: pa.Array, most: int | None = None) -> Words:
    """Words and windows of whole texts; ``most`` windows a text, evenly spread, for training.

    A text without words has one window of length 0.
    """
    return _featurize(column, most)[0]


def _featurize(column: pa.Array, most: int | None) -> tuple[Words, np.ndarray]:
    """:func:`featurize`, and the hashes of the distinct words."""
    raw, offs = text_buffer(column)
    raw = lower_ascii(raw)
    start, end, row = words_of(raw, offs)
    rows = len(offs) - 1
    distinct, first, which = np.unique(word_hashes(raw, start, end), return_index=True, return_inverse=True)
    s, e = start[first], end[first]
    # Character grams over "<word>": a shorter word is one gram.
    marked = np.full(int((e - s + 2).sum()), ord("<"), np.uint8)
    at = np.append(0, np.cumsum(e - s + 2))
    marked[at[1:] - 1] = ord(">")
    inner = np.arange(len(marked)) - np.repeat(at[:-1], e - s + 2) - 1
    body = (inner >= 0) & (inner < np.repeat(e - s, e - s + 2))
    marked[body] = raw[(np.repeat(s, e - s + 2) + inner)[body]]
    if len(marked) >= CHAR_GRAM:
        grams = rolling(mix(marked.astype(U64)), CHAR_GRAM)
    else:
        grams = np.zeros(0, U64)
    grams = np.append(grams, np.zeros(len(marked) - len(grams), U64))
    count = np.maximum(e - s + 2 - CHAR_GRAM + 1, 1)
    char_at = np.append(0, np.cumsum(count))
    place = np.repeat(at[:-1], count) + np.arange(char_at[-1]) - np.repeat(char_at[:-1], count)
    slots = (grams[place] % U64(CHAR_SLOTS)).astype(np.int64)
    short = e - s + 2 < CHAR_GRAM
    slots[char_at[:-1][short]] = (distinct[short] % U64(CHAR_SLOTS)).astype(np.int64)
    # Windows: every STRIDE words, the last one up to the end.
    per = np.bincount(row, minlength=rows)
    n = np.maximum(1, -(-(per - (WINDOW - STRIDE)) // STRIDE))
    base = np.cumsum(per) - per
    if most:
        taken = np.minimum(n, most)
    else:
        taken = n
    owner = np.repeat(np.arange(rows), taken)
    k = np.arange(len(owner)) - np.repeat(np.cumsum(taken) - taken, taken)
    k = k * n[owner] // taken[owner]
    begin = base[owner] + k * STRIDE
    length = np.minimum(WINDOW, base[owner] + per[owner] - begin)
    return Words(which, (distinct >> U64(20)).astype(np.int64) % WORD_SLOTS, slots, char_at, begin, length, owner), distinct


def featurize_slices(column: pa.Array, most: int | None = None) -> Words:
    """:func:`featurize` of a column that is worked on a slice at a time: only words and windows of all of it are held at once."""
    parts = [_featurize(piece, most) for piece in row_slices(column)]
    if len(parts) < 2:
        return featurize(column, most)
    distinct, first, number = np.unique(np.concatenate([d for _, d in parts]), return_index=True, return_inverse=True)
    found = [f for f, _ in parts]
    before = lambda sizes: np.cumsum([0, *sizes[:-1]])
    join = lambda arrays, shifts: np.concatenate([a + k for a, k in zip(arrays, shifts)])
    words, rows = before([len(f.which) for f in found]), before([int(f.row[-1]) + 1 for f in found])
    which = np.concatenate([number[k : k + len(d)][f.which] for (f, d), k in zip(parts, before([len(d) for _, d in parts]))])
    chars = np.concatenate([f.char_slot for f in found])
    start = join([f.char_at[:-1] for f in found], before([len(f.char_slot) for f in found]))[first]
    count = np.concatenate([np.diff(f.char_at) for f in found])[first]
    char_at = np.append(0, np.cumsum(count))
    place = np.repeat(start, count) + np.arange(char_at[-1]) - np.repeat(char_at[:-1], count)
    length = np.concatenate([f.length for f in found])
    windows, row = join([f.windows for f in found], words), join([f.row for f in found], rows)
    return Words(which, (distinct >> U64(20)).astype(np.int64) % WORD_SLOTS, chars[place], char_at, windows, length, row)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Network:
    """Weights, and the forward and backward passes."""

    w: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def fresh(cls, seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        normal = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        d, h, a = WORD_DIM + CHAR_DIM, HIDDEN, ATTENTION
        w = {"word": normal(WORD_SLOTS, WORD_DIM, scale=0.1), "char": normal(CHAR_SLOTS, CHAR_DIM, scale=0.1)}
        for way in "fb":
            w |= {f"x{way}": normal(d, 3 * h, scale=0.3), f"h{way}": normal(h, 3 * h, scale=0.3), f"c{way}": np.zeros(3 * h, np.float32)}
        w |= {"att": normal(2 * h, a, scale=0.4), "att_c": np.zeros(a, np.float32), "att_v": normal(a, scale=0.4)}
        w |= {"out": normal(2 * h, scale=0.4), "bias": np.zeros(1, np.float32), "shift": np.zeros(1, np.float32)}
        return cls(w)

    def inputs(self, f: Words) -> np.ndarray:
        """Input vectors of the distinct words."""
        n = np.diff(f.char_at)
        sums = np.add.reduceat(self.w["char"][f.char_slot], f.char_at[:-1], axis=0) if len(n) else np.zeros((0, CHAR_DIM), np.float32)
        return np.concatenate([self.w["word"][f.word_slot], sums / np.maximum(n, 1)[:, None].astype(np.float32)], axis=1)

    def _run(self, x: np.ndarray, length: np.ndarray, way: str, keep: bool):
        """States of one direction, time first; x holds the projected inputs, time first."""
        h3, size = self.w[f"h{way}"], HIDDEN
        steps = range(len(x)) if way == "f" else range(len(x) - 1, -1, -1)
        h = np.zeros((x.shape[1], size), np.float32)
        states = np.empty((len(x), x.shape[1], size), np.float32)
        saved = {}
        for t in steps:
            g = h @ h3
            zr = _sigmoid(x[t, :, : 2 * size] + g[:, : 2 * size])
            z, r = zr[:, :size], zr[:, size:]
            n = np.tanh(x[t, :, 2 * size :] + r * g[:, 2 * size :])
            on = (t < length)[:, None]
            new = np.where(on, n + z * (h - n), h)
            if keep:
                saved[t] = (h, z, r, n, g[:, 2 * size :], on)
            states[t] = h = new
        return states, saved

    def forward(self, words: np.ndarray, length: np.ndarray, inputs: np.ndarray, keep: bool = False):
        """Logits of windows; words (windows x time) are rows of inputs."""
        w = self.w
        proj = {way: inputs @ w[f"x{way}"] + w[f"c{way}"] for way in "fb"}
        order = np.ascontiguousarray(words.T)
        parts, saved = [], {}
        for way in "fb":
            states, saved[way] = self._run(proj[way][order], length, way, keep)
            parts.append(states)
        s = np.concatenate(parts, axis=2)
        act = np.tanh(s @ w["att"] + w["att_c"])
        e = act @ w["att_v"]
        e[np.arange(len(e))[:, None] >= length[None, :]] = -30
        e -= e.max(axis=0)
        p = np.exp(e)
        p /= p.sum(axis=0)
        pooled = (p[:, :, None] * s).sum(axis=0)
        pooled[length == 0] = 0
        logit = pooled @ w["out"] + w["bias"][0]
        return (logit, (order, length, inputs, saved, s, act, p, pooled)) if keep else logit

    def backward(self, d_logit: np.ndarray, kept) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Gradients of the weights, and of the inputs."""
        w, size = self.w, HIDDEN
        order, length, inputs, saved, s, act, p, pooled = kept
        grads = {"out": pooled.T @ d_logit, "bias": d_logit.sum(keepdims=True)}
        d_pooled = d_logit[:, None] * w["out"] * (length > 0)[:, None]
        d_s = p[:, :, None] * d_pooled
        d_p = (s * d_pooled).sum(axis=2)
        d_e = p * (d_p - (p * d_p).sum(axis=0))
        grads["att_v"] = np.tensordot(act, d_e, axes=([0, 1], [0, 1]))
        d_act = d_e[:, :, None] * w["att_v"] * (1 - act * act)
        grads["att"] = np.tensordot(s, d_act, axes=([0, 1], [0, 1]))
        grads["att_c"] = d_act.sum(axis=(0, 1))
        d_s = d_s + d_act @ w["att"].T
        d_inputs = np.zeros_like(inputs)
        for way, d_states in (("f", d_s[:, :, :size]), ("b", d_s[:, :, size:])):
            steps = range(len(s) - 1, -1, -1) if way == "f" else range(len(s))
            h3 = w[f"h{way}"]
            d_h3, d_x = np.zeros_like(h3), np.empty((*order.shape, 3 * size), np.float32)
            d_h = np.zeros_like(d_states[0])
            for t in steps:
                h, z, r, n, gn, on = saved[way][t]
                d_new = d_h + d_states[t]
                d_on = np.where(on, d_new, 0)
                d_n = d_on * (1 - z) * (1 - n * n)
                d_z = d_on * (h - n) * z * (1 - z)
                d_r = d_n * gn * r * (1 - r)
                d_x[t] = np.concatenate([d_z, d_r, d_n], axis=1)
                d_g = np.concatenate([d_z, d_r, d_n * r], axis=1)
                d_h3 += h.T @ d_g
                d_h = np.where(on, d_on * z, d_new) + d_g @ h3.T
            flat = d_x.reshape(-1, 3 * size)
            grads |= {f"h{way}": d_h3, f"c{way}": flat.sum(axis=0)}
            # Sum over the occurrences of each distinct word first.
            which, at = np.unique(order.ravel(), return_inverse=True)
            per = np.zeros((len(which), 3 * size), np.float32)
            np.add.at(per, at, flat)
            grads[f"x{way}"] = inputs[which].T @ per
            d_inputs[which] += per @ w[f"x{way}"].T
        return grads, d_inputs


def _grid(f: Words, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct word numbers (windows x time) and lengths of some windows; places past the end repeat a word."""
    length = f.length[pick]
    time = np.arange(max(1, int(length.max(initial=1))))
    if not len(f.which):
        return np.zeros((len(pick), len(time)), np.int64), length
    place = f.windows[pick][:, None] + np.minimum(time, np.maximum(length - 1, 0)[:, None])
    return f.which[np.minimum(place, len(f.which) - 1)], length


def window_logits(net: Network, f: Words, step: int = 2048) -> np.ndarray:
    inputs = net.inputs(f)
    if not len(inputs):
        inputs = np.zeros((1, WORD_DIM + CHAR_DIM), np.float32)
    out = np.empty(len(f.windows), np.float32)
    order = np.argsort(f.length, kind="stable")  # windows of like length together
    for at in range(0, len(order), step):
        pick = order[at : at + step]
        out[pick] = net.forward(*_grid(f, pick), inputs)
    return out


def text_logits(net: Network, f: Words, rows: int) -> np.ndarray:
    best = np.full(rows, -np.inf, np.float32)
    np.maximum.at(best, f.row, window_logits(net, f))
    return best - net.w["shift"][0]


class Adam:
    """Steps of gradient descent with running moments of the weights' gradients."""

    def __init__(self, net: Network):
        self.moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in net.w.items()}
        self.steps = 0

    def step(self, net: Network, f: Words, windows: np.ndarray, labels: np.ndarray, weight: np.ndarray, rate: float) -> None:
        """One batch: a window for each text, its label and weight."""
        words, length = _grid(f, windows)
        used, words = np.unique(words, return_inverse=True)
        words = words.reshape(len(windows), -1)
        part = Words(words, f.word_slot[used], *_chars(f, used), np.zeros(0), np.zeros(0), np.zeros(0)) if len(f.which) else None
        inputs = net.inputs(part) if part else np.zeros((1, WORD_DIM + CHAR_DIM), np.float32)
        logit, kept = net.forward(words, length, inputs, keep=True)
        d = (_sigmoid(logit) - labels) * weight / len(windows)
        grads, d_in = net.backward(d.astype(np.float32), kept)
        if part:
            grads["word"] = np.zeros_like(net.w["word"])
            np.add.at(grads["word"], part.word_slot, d_in[:, :WORD_DIM])
            grads["char"] = np.zeros_like(net.w["char"])
            n = np.diff(part.char_at)
            np.add.at(grads["char"], part.char_slot, np.repeat(d_in[:, WORD_DIM:] / np.maximum(n, 1).astype(np.float32)[:, None], n, axis=0))
        self.steps += 1
        for k, g in grads.items():
            m, v = self.moments[k]
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            net.w[k] -= rate * (m / (1 - 0.9**self.steps)) / (np.sqrt(v / (1 - 0.99**self.steps)) + 1e-6)


def fit(texts: list[str], labels: np.ndarray, share: float, epochs: int = 14, batch: int = 128, seed: int = 7, held: np.ndarray | None = None) -> Network:
    """Train on texts with labels 0 or 1; ``share`` is the true share of label 1.

    ``epochs`` holds from about 2700 training rows on. Fewer rows are read more often, up to 60 times, so that every network is
    trained for at least some 300 batches.

    In the first epochs a random window stands for its text, later the highest-scored
    one. A fifth of the texts (``held``, random if not given) only sets the cut between the classes.
    """
    net = Network.fresh(seed)
    rng = np.random.default_rng(seed)
    labels = np.asarray(labels, np.float32)
    if not len(texts) or labels.min() == labels.max():
        # Nothing to tell apart: every text gets the share as its score.
        net.w["out"][:] = 0
        net.w["bias"][0] = np.log(max(share, 1e-3) / max(1 - share, 1e-3))
        return net
    f = featurize_slices(pa.array(texts, pa.string()), MAX_WINDOWS)
    drawn = rng.random(len(texts)) < 0.2
    held = drawn if held is None else held.copy()
    if held.all() or labels[~held].min() == labels[~held].max():
        held[:] = False
    by_row = np.split(np.arange(len(f.row)), np.cumsum(np.bincount(f.row, minlength=len(texts)))[:-1])
    adam = Adam(net)
    train = np.flatnonzero(~held)
    weight = np.where(labels == 1, 0.5 / max(labels[train].mean(), 1e-6), 0.5 / max(1 - labels[train].mean(), 1e-6)).astype(np.float32)
    epochs = max(epochs, min(60, 300 * batch // max(1, len(train))))
    for epoch in range(epochs):
        if epoch < epochs // 4:
            chosen = np.array([x[rng.integers(len(x))] for x in by_row])
        else:
            scores = window_logits(net, f)
            chosen = np.array([x[np.argmax(scores[x])] for x in by_row])
        rate = 0.01 * (1 - 0.9 * epoch / epochs)
        for rows in np.array_split(rng.permutation(train), max(1, len(train) // batch)):
            adam.step(net, f, chosen[rows], labels[rows], weight[rows], rate)
    # The cut: fewest errors at the true share, in the middle of the best range.
    logits = text_logits(net, f, len(texts))
    both = labels[held].sum() >= 20 and (labels[held] == 0).any()
    judge = held if both else np.ones(len(texts), bool)
    x, y = logits[judge], labels[judge]
    cuts = np.append(np.unique(x), x.max() + 1)
    miss = np.array([(x[y == 1] < c).mean() * share + (x[y == 0] >= c).mean() * (1 - share) for c in cuts])
    best = np.flatnonzero(miss == miss.min())
    lower = cuts[best - 1] if best[0] else cuts[best]
    middle = (cuts[best] + np.where(best > 0, lower, cuts[best])) / 2
    net.w["shift"][0] = middle[len(middle) // 2]
    return net


def _chars(f: Words, used: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = np.diff(f.char_at)[used]
    at = np.append(0, np.cumsum(n))
    place = np.repeat(f.char_at[used], n) + np.arange(at[-1]) - np.repeat(at[:-1], n)
    return f.char_slot[place], at


def _usable(labels: DataFrame) -> DataFrame:
    """Ids and labels that may be learned from."""
    return labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(
        "doc_id IS NOT NULL AND toxic IN (0, 1) AND crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 <> 0"
    )


def training_rows(docs: DataFrame, labels: DataFrame) -> tuple[list[str], np.ndarray, float]:
    """A bounded sample of labelled rows to start from: texts (their training windows), labels, share of label 1."""
    return _sample(docs, labels)[:3]


def _sample(docs: DataFrame, labels: DataFrame) -> tuple[list[str], np.ndarray, float, np.ndarray]:
    """The sample of :func:`training_rows`, and which of its rows are held back.

    Rows whose crc32 of the doc_id as text is a multiple of 5 are never read. Of each
    class the MAX_ROWS rows with the smallest hash of the doc_id are taken. An id with several labels or texts counts
    once, with the smallest label and text.
    """
    usable = _usable(labels)
    share = usable.agg(F.avg("toxic").alias("s")).first()["s"]
    order = [F.xxhash64("doc_id"), "doc_id", "toxic"]
    picked = usable.where("toxic = 1").orderBy(*order).limit(MAX_ROWS).unionByName(usable.where("toxic = 0").orderBy(*order).limit(MAX_ROWS))

    def spread(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for part in parts:
            raw, offs = text_buffer(part["text"])
            start, end, row = words_of(raw, offs)
            data, texts = raw.tobytes(), []
            for i in range(part.num_rows):
                a, b = np.searchsorted(row, [i, i + 1])
                size = MAX_WINDOWS * WINDOW
                if b - a <= size:
                    spans = [(a, b)]
                else:
                    spans = [(int(x), int(x) + WINDOW) for x in np.linspace(a, b - WINDOW, MAX_WINDOWS)]
                texts.append(b" ".join(data[start[k] : end[k]][:256] for x, y in spans for k in range(x, y)).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([part["doc_id"], part["toxic"], pa.array(texts, pa.string())], names=["doc_id", "toxic", "text"])

    texts = docs.selectExpr("CAST(doc_id AS LONG) AS doc_id", "COALESCE(text, '') AS text")
    # At most 2 * MAX_ROWS ids: a broadcast of a proven bound.
    rows = texts.join(F.broadcast(picked), "doc_id").mapInArrow(spread, "doc_id long, toxic int, text string")
    one = rows.groupBy("doc_id").agg(F.min(F.struct("toxic", "text")).alias("r"))
    found = sorted(collect_and_drop_shuffles(one.select("doc_id", "r.*", (F.xxhash64("doc_id") > HELD_ABOVE).alias("held"))))
    return [r["text"] for r in found], np.array([r["toxic"] for r in found], np.float32), float(share or 0.0), np.array([r["held"] for r in found], bool)


def train(docs: DataFrame, labels: DataFrame) -> Network:
    """Fit a network on all labelled documents: on the sample, and on all of them if the sample isn't all."""
    texts, toxic, share, held = _sample(docs, labels)
    few = len(texts) and labels_within(labels, MAX_ROWS)
    net = fit(texts, toxic, share) if few else fit(texts, toxic, share, held=held)
    release()  # What training took of the driver's memory.
    if few or not len(texts) or toxic.min() == toxic.max():
        return net
    return train_on_all(net, docs, labels, share)


def labels_within(labels: DataFrame, most: int) -> bool:
    """Whether the sample takes all usable labels."""
    return all(r["count"] <= most for r in _usable(labels).groupBy("toxic").count().collect())


def train_on_all(net: Network, docs: DataFrame, labels: DataFrame, share: float, rate: float = 0.005) -> Network:
    """Go on training over all labelled rows, whole texts with all windows, and set the cut by all rows held back.

    Rows are dealt by their id to shards. In a round each shard is read once, from the weights of the round before: the highest-scored
    window stands for its text. The shards' weights are averaged by their rows. Few rows are read in several rounds.
    An id with several labels or texts counts once, as in the sample.
    """
    usable = _usable(labels)
    rows = usable.count()
    shards = max(2, -(-rows // SHARD_ROWS))
    rounds = max(1, min(10, 300 * 128 // max(1, rows)))
    texts = docs.selectExpr("CAST(doc_id AS LONG) AS doc_id", "COALESCE(text, '') AS text")
    # A shard is a task's partition: texts move once, to join their labels there.
    own = (
        _perhaps_labelled(texts, usable, rows).repartition(shards, "doc_id")
        .join(usable.repartition(shards, "doc_id"), "doc_id")
        .groupBy("doc_id")
        .agg(F.min(F.struct("toxic", "text")).alias("r"))
        .select((F.xxhash64("doc_id") > HELD_ABOVE).alias("held"), "r.*")
    )
    sc = docs.sparkSession.sparkContext

    for turn in range(rounds):
        start, now = sc.broadcast(net.w), rate * (1 - 0.9 * turn / rounds)

        def learn(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            release()
            model = Network({k: v.copy() for k, v in start.value.items()})
            adam, seen = Adam(model), 0
            for part in parts:
                toxic, at = part["toxic"].to_numpy(zero_copy_only=False).astype(np.float32), 0
                for piece in row_slices(part["text"]):
                    y = toxic[at : at + len(piece)]
                    at += len(piece)
                    f = featurize(piece)
                    weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
                    chosen = _highest(window_logits(model, f), f.row, len(y))
                    for k in range(0, len(y), SHARD_BATCH):
                        span = slice(k, k + SHARD_BATCH)
                        adam.step(model, f, chosen[span], y[span], weight[span], now)
                    seen += len(y)
            if seen:
                yield _changes(start.value, model.w, seen)

        def mean(pieces: pa.Table) -> pa.Table:
            piece = pieces["piece"].slice(0, 1)
            return pa.table({"piece": piece, "w": pa.array([_mean(start.value, piece[0].as_py(), pieces).tobytes()], pa.binary())})

        learned = own.where("NOT held").select("toxic", "text").mapInArrow(learn, "piece int, n long, changed binary, w binary")
        # One network's weights, whatever the number of rows or shards.
        found = sorted(collect_and_drop_shuffles(learned.groupBy("piece").applyInArrow(mean, "piece int, w binary")))
        start.unpersist()
        if not found:
            return net
        flat, at = np.frombuffer(b"".join(bytes(r["w"]) for r in found), np.float32), 0
        fresh = {}
        for k in sorted(net.w):
            size = net.w[k].size
            fresh[k], at = flat[at : at + size].reshape(net.w[k].shape).copy(), at + size
        net = Network(fresh)
    net.w["shift"][:] = 0
    return _with_cut(net, own, share)


def _flat(w: dict[str, np.ndarray]) -> np.ndarray:
    """All weights one after the other, in the order of their names."""
    return np.concatenate([w[k].ravel() for k in sorted(w)]).astype(np.float32)


def _changes(before: dict[str, np.ndarray], after: dict[str, np.ndarray], rows: int) -> pa.RecordBatch:
    """The weights that a shard's training changed, by pieces: which ones, as bits, and their values.

    Embeddings of words that a shard doesn't have stay as they were. So small shards, however many, hand on little.
    """
    old, new = _flat(before), _flat(after)
    differs = old != new
    spans = [slice(i, i + PIECE) for i in range(0, len(new), PIECE)]
    which = [np.packbits(differs[x]).tobytes() for x in spans]
    values = [new[x][differs[x]].tobytes() for x in spans]
    return pa.RecordBatch.from_arrays(
        [pa.array(range(len(spans)), pa.int32()), pa.array([rows] * len(spans), pa.int64()), pa.array(which, pa.binary()), pa.array(values, pa.binary())],
        names=["piece", "n", "changed", "w"],
    )


def _mean(before: dict[str, np.ndarray], piece: int, changes: pa.Table) -> np.ndarray:
    """A piece's mean over the shards by their rows; what a shard didn't change counts as it was before."""
    old = _flat(before)[piece * PIECE : (piece + 1) * PIECE]
    total, rows = np.zeros(len(old)), 0
    for n, which, w in zip(*(changes[k].to_pylist() for k in ("n", "changed", "w"))):
        one = old.copy()
        one[np.unpackbits(np.frombuffer(which, np.uint8), count=len(old)).astype(bool)] = np.frombuffer(w, np.float32)
        total += n * one.astype(np.float64)
        rows += n
    return (total / rows).astype(np.float32)


#: Bits that ids with labels are marked in: of one bitmap, for each label at least, and in all at most for which the bitmaps are broadcast.
_BITMAP, _BITS, _BROADCAST_BITS = 15, 8, 1 << 30


def _perhaps_labelled(texts: DataFrame, usable: DataFrame, rows: int) -> DataFrame:
    """Texts whose id has a label, and a few others: those whose hash has the bit of some labelled id, of eight or more for each label."""
    size = max(_BITMAP, (_BITS * rows - 1).bit_length())
    hashed = F.xxhash64(F.lit(2), "doc_id").bitwiseAND((1 << size) - 1)
    at = hashed.bitwiseAND((1 << _BITMAP) - 1)
    marks = usable.groupBy(F.shiftright(hashed, _BITMAP).alias("_bucket")).agg(F.bitmap_construct_agg(at).alias("_marks"))
    marks = F.broadcast(marks) if 1 << size <= _BROADCAST_BITS else marks
    byte = F.conv(F.hex(F.substring("_marks", F.shiftright(at, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = F.getbit(byte, at.bitwiseAND(7).cast("int")) == 1
    return texts.withColumn("_bucket", F.shiftright(hashed, _BITMAP)).join(marks, "_bucket").where(marked).select("doc_id", "text")


def _highest(logits: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """The first highest-scored window of each text."""
    order = np.lexsort((np.arange(len(row)), -logits, row))
    return order[np.searchsorted(row[order], np.arange(rows))]


def _with_cut(net: Network, own: DataFrame, share: float) -> Network:
    """The network with the cut of fewest errors at the true share, counted over all rows held back (over all, if they hold few of label 1)."""
    weights = own.sparkSession.sparkContext.broadcast(net.w)

    def place(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        model = Network(weights.value)
        for part in parts:
            logits = [text_logits(model, featurize(piece), len(piece)) for piece in row_slices(part["text"])]
            bins = np.floor(np.clip(np.concatenate(logits) if logits else np.zeros(0), -LOGIT_MOST, LOGIT_MOST) * BINS).astype(np.int32)
            yield pa.RecordBatch.from_arrays([part["toxic"], pa.array(bins, pa.int32())], names=["toxic", "bin"])

    def counts(rows: DataFrame) -> np.ndarray:
        n = np.zeros((2, 2 * LOGIT_MOST * BINS + 1))
        for r in collect_and_drop_shuffles(rows.select("toxic", "text").mapInArrow(place, "toxic int, bin int").groupBy("toxic", "bin").count()):
            n[r["toxic"], r["bin"] + LOGIT_MOST * BINS] += r["count"]
        return n

    n = counts(own.where("held"))
    if n[1].sum() < 20 or not n[0].sum():
        n = counts(own)
    # A cut before bin i calls all from bin i on toxic.
    missed = np.append(0, np.cumsum(n[1])) / max(n[1].sum(), 1)
    wrong = 1 - np.append(0, np.cumsum(n[0])) / max(n[0].sum(), 1)
    miss = missed * share + wrong * (1 - share)
    best = np.flatnonzero(miss <= miss.min() + 1e-12)
    # The longest run of best cuts is the widest gap between the classes.
    spans = np.split(best, np.flatnonzero(np.diff(best) > 1) + 1)
    widest = max(spans, key=len)
    net.w["shift"][0] = (widest[0] + widest[-1]) / 2 / BINS - LOGIT_MOST
    return net


def score(docs: DataFrame, net: Network, column: str = "score") -> DataFrame:
    """``docs`` with the toxicity score (0 to 1) of each whole text in ``column``.

    All rows and columns are kept; a column of that name is replaced. Texts of any length are scored whole, an empty table gives an empty one. Null texts
    count as empty, and a text without words scores as one empty window. Equal texts
    get equal scores; doc_id and other columns play no part.
    """
    weights = docs.sparkSession.sparkContext.broadcast(net.w)
    kept = docs.drop(column)
    schema = T.StructType([*kept.schema.fields, T.StructField(column, T.DoubleType())])

    def apply(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        model = Network(weights.value)
        for part in parts:
            scores = []
            for texts in row_slices(part["text"]):
                logits = text_logits(model, featurize(texts), len(texts)).astype(np.float64)
                scores.append(1 / (1 + np.exp(-np.clip(logits, -500, 500))))
            value = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(value, pa.float64())], names=[*part.schema.names, column])

    return kept.mapInArrow(apply, schema)
