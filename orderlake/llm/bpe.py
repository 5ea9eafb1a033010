"""Byte-level byte-pair encoding with a rank queue on hierarchical bitmaps.

A pre-token is a linked list of parts. Every adjacent pair whose joined bytes are a
token waits in the bucket of that token's rank. Two levels of bitmaps say
which buckets are filled, so the next rank to merge is found with two
find-first-set steps however long the pre-token is; entries whose parts have
changed meanwhile are stale and skipped. One merge costs the same in a
pre-token of ten bytes and of ten million.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Callable, Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from orderlake.llm._arrays import held, part_slices

#: Distinct pre-tokens whose results a Python worker keeps.
KEPT = 3 << 17
#: Longer pre-tokens aren't kept.
KEPT_CHARS = 64
#: Ids whose decimal form and bytes are gathered at once.
STEP = 1 << 16
_LEAF = 9  # ranks per leaf bitmap, as a power of two
_MASK = (1 << _LEAF) - 1


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a file with a base64 token and a rank per line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def encode_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one pre-token."""
    get = ranks.get
    whole = get(word)
    if whole is not None:
        return [whole]
    n = len(word)
    # Places of the pairs of each rank, as heaps: the leftmost comes first.
    # Filled buckets have a bit per rank in the leaves and a bit per filled leaf in the top.
    buckets: dict[int, list[int]] = {}
    leaves: dict[int, int] = {}
    top = 0
    for i in range(n - 1):
        rank = get(word[i : i + 2])
        if rank is not None:
            if rank in buckets:
                buckets[rank].append(i)
            else:
                buckets[rank] = [i]
                leaf = rank >> _LEAF
                if leaf in leaves:
                    leaves[leaf] |= 1 << (rank & _MASK)
                else:
                    leaves[leaf] = 1 << (rank & _MASK)
                    top |= 1 << leaf
    # Part i spans word[i:after[i]]; before[i] is where the previous part starts; after is 0 in merged parts.
    after, before = list(range(1, n + 2)), list(range(-1, n))
    while top:
        leaf = (top & -top).bit_length() - 1
        bits = leaves[leaf]
        rank = leaf << _LEAF | (bits & -bits).bit_length() - 1
        bucket = buckets[rank]
        if len(bucket) > 1:
            i = heappop(bucket)
        else:
            i = bucket[0]
            del buckets[rank]
            bits &= bits - 1
            if bits:
                leaves[leaf] = bits
            else:
                del leaves[leaf]
                top ^= 1 << leaf
        j = after[i]
        if not j or j >= n:
            continue  # the part is gone, or is the last
        k = after[j]
        if get(word[i:k]) != rank:
            continue  # stale: a neighbour has changed
        after[i], after[j] = k, 0
        start, end = i, 0
        if k < n:
            before[k] = i
            end = after[k]
        while True:
            # The new part with its right neighbour, then with its left one.
            if end:
                rank = get(word[start:end])
                if rank is not None:
                    if rank in buckets:
                        heappush(buckets[rank], start)
                    else:
                        buckets[rank] = [start]
                        leaf = rank >> _LEAF
                        if leaf in leaves:
                            leaves[leaf] |= 1 << (rank & _MASK)
                        else:
                            leaves[leaf] = 1 << (rank & _MASK)
                            top |= 1 << leaf
            if start != i or not i:
                break
            start, end = before[i], k
    out = []
    i = 0
    while i < n:
        j = after[i]
        out.append(ranks[word[i:j]])
        i = j
    return out


class _Kept(dict):
    """Packed ids of pre-tokens used of late. Those before them are asked first, so what is used again stays."""

    def __init__(self, ranks: dict[bytes, int], kind: str):
        self._ranks, self._kind = ranks, kind
        self._older: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        ids = self._older.get(word)
        if ids is None:
            ids = array(self._kind, encode_word(word.encode("utf-8"), self._ranks)).tobytes()
        if len(word) <= KEPT_CHARS:
            if len(self) >= KEPT:
                self._older = dict(self)
                self.clear()
            self[word] = ids
        return ids


class Codec:
    """Encoder and decoder for one rank file; equal pre-tokens are worked out once while kept.

    Of a kept pre-token only its packed ids stay. The ids of a text are these joined; their decimal
    form and the bytes they decode to are gathered from two tables by id.
    """

    def __init__(self, path: str, pattern: str):
        self.ranks = read_ranks(path)
        most = max(self.ranks.values(), default=0)
        self.kind = np.dtype("<u2" if most < 1 << 16 else "<u4")
        # By id: the decimal digits and a space, padded with zero bytes, and where the token's bytes lie.
        self._digits = np.zeros((most + 1, len(str(most)) + 1), np.uint8)
        self._start, self._size = np.zeros(most + 1, np.int64), np.full(most + 1, -1, np.int64)
        joined, at = [], 0
        for token, rank in self.ranks.items():
            digits = b"%d " % rank
            self._digits[rank, : len(digits)] = np.frombuffer(digits, np.uint8)
            self._start[rank], self._size[rank] = at, len(token)
            joined.append(token)
            at += len(token)
        self._width = np.count_nonzero(self._digits, axis=1)
        self._bytes = np.frombuffer(b"".join(joined) or b"\0", np.uint8)
        self._find = regex.compile(pattern).findall
        self._ids_of = _Kept(self.ranks, "H" if self.kind.itemsize == 2 else "I").__getitem__

    def packed(self, text: str) -> bytes:
        """The packed ids of a text."""
        return b"".join(map(self._ids_of, self._find(text)))

    def ids(self, text: str) -> np.ndarray:
        return np.frombuffer(self.packed(text), self.kind)

    def encode(self, text: str) -> list[int]:
        return self.ids(text).tolist()

    def decimals(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids in decimal form, a space behind each, as one run of bytes, and where each ends in it."""
        rows = self._digits[ids]
        return rows[rows != 0], np.cumsum(self._width[ids])

    def spelled(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes that ids decode to as one run, and where each id's bytes end in it."""
        size = self._size[ids]
        if len(size) and size.min() < 0:
            raise KeyError("an id without a token")
        ends = np.cumsum(size)
        at = np.repeat(self._start[ids] - ends + size, size)
        at += np.arange(len(at))
        return self._bytes[at], ends

    def decode(self, ids) -> bytes:
        ids = np.asarray(ids, np.int64)
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self._size)):
            raise KeyError("an id without a token")
        return b"".join(self.spelled(ids[at : at + STEP])[0].tobytes() for at in range(0, len(ids), STEP))

    def digests(self, texts: list[str]) -> tuple[list[int], list[str], list[str]]:
        """Per text: number of ids, SHA-256 of them in decimal form, and SHA-256 of the bytes decoded from them."""
        parts = [self.packed(t) for t in texts]
        cuts = np.cumsum([0] + [len(p) // self.kind.itemsize for p in parts])
        ids = np.frombuffer(b"".join(parts), self.kind)
        del parts
        hashes = [(hashlib.sha256(), hashlib.sha256()) for _ in texts]
        for p in range(0, len(ids), STEP):
            q = min(p + STEP, len(ids))
            first, last = np.searchsorted(cuts, p, side="right") - 1, np.searchsorted(cuts, q, side="left")
            for k, (data, ends) in enumerate((self.decimals(ids[p:q]), self.spelled(ids[p:q]))):
                ends = np.append(0, ends)
                for i in range(first, last):
                    a, b = max(cuts[i], p), min(cuts[i + 1], q)
                    if a < b:  # the space behind a text's last id doesn't count
                        hashes[i][k].update(data[ends[a - p] : ends[b - p] - (k == 0 and b == cuts[i + 1])])
        return np.diff(cuts).tolist(), [x.hexdigest() for x, _ in hashes], [y.hexdigest() for _, y in hashes]


def codec(path: str, pattern: str) -> Codec:
    """The worker's codec, read once; kept until another operator's tasks come."""
    return held((path, pattern), lambda: Codec(path, pattern))


def _map(docs: DataFrame, path: Callable[[], str], pattern: str, name: str, kind: pa.DataType, ddl: str, row) -> DataFrame:
    def apply(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path(), pattern)
        for part in parts:
            # Rows of long texts go out in small batches.
            for at in range(0, part.num_rows, 512):
                piece = part.slice(at, 512)
                out = pa.array([row(c, t.as_py()) for t in piece["_in"]], kind)
                yield pa.RecordBatch.from_arrays([piece["doc_id"], out], names=["doc_id", name])

    return docs.mapInArrow(apply, f"doc_id long, {name} {ddl}")


def vocabulary(file: str) -> Callable[[], str]:
    """Where each worker finds an installed vocabulary file."""

    def path() -> str:
        import public_tokenizers

        return public_tokenizers.path(file)

    return path


def encode(docs: DataFrame, path: Callable[[], str], pattern: str) -> DataFrame:
    """doc_id and ids (array<int>) of each text.

    ``path`` is called on the workers and returns the rank file. Null texts count as
    empty and have no ids; repeated rows and null doc_ids are kept as they are; other
    columns are ignored. Characters that no match of the pattern holds are left out, as
    the pattern says.
    """
    keyed = docs.selectExpr("CAST(doc_id AS LONG) AS doc_id", "COALESCE(text, '') AS _in")
    return _map(keyed, path, pattern, "ids", pa.list_(pa.int32()), "array<int>", lambda c, t: c.encode(t))


def decode(encoded: DataFrame, path: Callable[[], str], pattern: str) -> DataFrame:
    """doc_id and bytes (binary) of each id list; null lists count as empty."""
    keyed = encoded.selectExpr("CAST(doc_id AS LONG) AS doc_id", "COALESCE(ids, array()) AS _in")
    return _map(keyed, path, pattern, "bytes", pa.binary(), "binary", lambda c, ids: c.decode(ids))


_DIGEST = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def round_trip(docs: DataFrame, path: Callable[[], str], pattern: str) -> DataFrame:
    """Digests of each text's ids and of the bytes decoded from them, in one pass.

    Same rules as :func:`encode`; the ids stay inside the task. An empty text has no ids, and both its digests are those of
    no bytes; an empty table gives an empty result. A long text is encoded whole, its ids are turned into text and bytes
    a step at a time.
    """

    def apply(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path(), pattern)
        for part in parts:
            for piece in part_slices(part, "_in"):
                n, ids, back = c.digests(piece["_in"].to_pylist())
                yield pa.RecordBatch.from_arrays([piece["doc_id"], pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())], schema=_DIGEST)

    return docs.selectExpr("CAST(doc_id AS LONG) AS doc_id", "COALESCE(text, '') AS _in").mapInArrow(
        apply, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
