"""Small numpy helpers shared by the text operators.

They work on one Arrow batch at a time: the texts of a batch lie one after
the other in one byte buffer, so fingerprints are computed for all of them
with a few vector operations and no Python loop over characters.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Hashable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa

U64 = np.uint64
_ODD = [U64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
_BASES = (U64(0x5851F42D4C957F2D), U64(0x2545F4914F6CDD1D))
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
#: Bytes past the end that eight-byte reads may touch.
PAD = 128
_HELD: dict[Hashable, Any] = {}


def held(key: Hashable, make: Callable[[], Any]) -> Any:
    """An object that this Python worker keeps between tasks; at most one at a time."""
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = make()
    return _HELD[key]


def release() -> None:
    """Free what another operator's tasks left in this worker, which Spark uses again.

    Arrow takes memory from the C heap from then on, and what is free there goes back to the system.
    """
    _HELD.clear()
    _POWERS.clear()
    pa.default_memory_pool().release_unused()
    pa.set_memory_pool(pa.system_memory_pool())
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def tidy(apply: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``apply`` with :func:`release` before and after it: nothing of a task stays in the worker."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        try:
            yield from apply(parts)
        finally:
            release()

    return run


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit words (multiply and xor-shift, a bijection)."""
    x = x * _ODD[0]
    x ^= x >> U64(32)
    x *= _ODD[1]
    x ^= x >> U64(29)
    return x


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string or binary column and the n + 1 offsets of its rows.

    Nulls count as empty.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if column.null_count:
        column = column.fill_null(b"" if "binary" in str(column.type) else "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    kind = np.int64 if large else np.int32
    offs = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def row_slices(column: pa.Array, size: int = 1 << 21) -> Iterator[pa.Array]:
    """Slices of a text column with about ``size`` bytes each, at least a row: what is worked on at once stays small."""
    _, offs = text_buffer(column)
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(offs, offs[a] + size, side="right")) - 1)
        yield column.slice(a, b - a)
        a = b


def part_slices(part: pa.RecordBatch, column: str, size: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """A batch cut as :func:`row_slices` cuts its text column."""
    at = 0
    for texts in row_slices(part.column(column), size):
        yield part.slice(at, len(texts))
        at += len(texts)


def padded(raw: np.ndarray) -> np.ndarray:
    """A copy with PAD zero bytes behind it."""
    out = np.zeros(len(raw) + PAD, np.uint8)
    out[: len(raw)] = raw
    return out


def eights(buffer: np.ndarray) -> np.ndarray:
    """The eight bytes from each position as one little-endian word."""
    return np.ndarray(len(buffer) - 7, dtype="<u8", buffer=buffer, strides=(1,)).astype(U64, copy=True)


def powers(n: int, which: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64 and of its inverse, n of each."""
    known = _POWERS.get(which)
    if known is None or len(known[0]) < n:
        size = 1 << max(10, (n - 1).bit_length())
        base = _BASES[which]
        inverse = U64(pow(int(base), -1, 1 << 64))
        tables = []
        for b in (base, inverse):
            t = np.full(size, b, U64)
            t[0] = 1
            tables.append(np.multiply.accumulate(t))
        known = _POWERS[which] = (tables[0], tables[1])
    return known[0][:n], known[1][:n]


class RangeHash:
    """Fingerprints of any ranges of a sequence of words, from prefix sums."""

    def __init__(self, words: np.ndarray, which: int = 0):
        up, self._down = powers(len(words) + 1, which)
        self._sums = np.zeros(len(words) + 1, U64)
        np.cumsum(words * up[: len(words)], out=self._sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of words[start:end] for each pair; empty ranges give 0."""
        end = np.maximum(start, end)
        return (self._sums[end] - self._sums[start]) * self._down[start]


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower_ascii(raw: np.ndarray) -> np.ndarray:
    return _LOWER[raw]


def words_of(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each run of bytes other than white space.

    White space is the space and the bytes 0x09 to 0x0D. Runs end at the end
    of their row.
    """
    n = len(raw)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    solid = ~_SPACE[raw]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    cuts = offs[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    first[cuts] = solid[cuts]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    last[cuts - 1] = solid[cuts - 1]
    start = np.flatnonzero(first)
    end = np.flatnonzero(last) + 1
    row = np.searchsorted(offs, start, side="right") - 1
    return start, end, row


def word_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit fingerprint of each byte range, about 64 KB of text at a time."""
    out = np.zeros(len(start), U64)
    step = (1 << 16) - 1
    at = 0
    while at < len(start):
        base = start[at]
        stop = max(at + 1, int(np.searchsorted(start, base + step)))
        top = int(end[stop - 1])
        span = mix(raw[base:top].astype(U64) + U64(1))
        h = RangeHash(span)
        s, e = start[at:stop] - base, end[at:stop] - base
        out[at:stop] = mix(h.of(s, e) + (e - s).astype(U64) * _ODD[2])
        at = stop
    return out


def rolling(words: np.ndarray, n: int) -> np.ndarray:
    """Fingerprint of each n words in a row; shorter than the input by n - 1."""
    out = words[: len(words) - n + 1].copy()
    for k in range(1, n):
        out = mix(out + _ODD[3]) + words[k : len(words) - n + 1 + k]
    return mix(out)


def batches(columns: dict[str, np.ndarray], schema: pa.Schema, step: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    """Arrays as record batches of bounded length."""
    n = len(next(iter(columns.values())))
    for at in range(0, n, step):
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.ascontiguousarray(columns[f.name][at : at + step]), f.type) for f in schema], schema=schema
        )


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
