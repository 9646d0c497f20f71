"""Array helpers shared by the text operators: Arrow string batches in, numpy
word and hash arrays out. Everything here works on one bounded slice of one
Arrow batch inside a Spark task; nothing is collected or kept between slices.

A *word* is a maximal run of bytes other than space and ``\\t..\\r`` (the
pattern ``[^\\x20\\x09-\\x0D]+``); on UTF-8 bytes this equals the same pattern
on code points, because the separators are single bytes that never occur
inside a longer sequence.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20  # text bytes worked on at once (a longer text is one slice of its own)
ROW_BYTES = 1 << 19  # the same where a slice gives a row per text and nothing is packed by slice
U64 = np.uint64

_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[9, 10, 11, 12, 13, 32]] = True


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (int64, n + 1) and bytes (uint8) of a string or binary array; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type)
                                  else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offs, data = column.buffers()
    off = np.frombuffer(offs, dtype=np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    off = off.astype(np.int64)
    if data is None or not len(column):
        return np.zeros(len(column) + 1, dtype=np.int64), np.zeros(0, dtype=np.uint8)
    raw = np.frombuffer(data, dtype=np.uint8)[off[0]:off[-1]]
    return off - off[0], raw


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into runs of rows with at most ``size`` bytes of text (one row at least)."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        off, _ = utf8(batch.column(batch.schema.get_field_index(column)))
        lo = 0
        while lo < n:
            hi = int(np.searchsorted(off, off[lo] + size, side="right")) - 1
            hi = min(max(hi, lo + 1), n)
            yield batch.slice(lo, hi - lo)
            lo = hi


_C = ctypes.CDLL(None)


def release() -> None:
    """Give memory back to the machine: Python workers outlive their tasks, and several share an executor's limit."""
    _POWERS.clear()
    pa.default_memory_pool().release_unused()
    if hasattr(_C, "malloc_trim"):  # glibc
        _C.malloc_trim(0)


def tidy(step: Callable) -> Callable:
    """A ``mapInArrow`` function that releases memory at the end of its task."""
    def run(batches):
        yield from step(batches)
        release()
    return run


def words(off: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and each text's word range (n + 1 offsets into them)."""
    sep = _SEPARATOR[data]
    before = np.empty(len(data), dtype=bool)
    before[:1] = True
    before[1:] = sep[:-1]
    heads = off[:-1][off[:-1] < len(data)]
    before[heads] = True
    starts = np.flatnonzero(before & ~sep)
    after = np.empty(len(data), dtype=bool)
    after[-1:] = True
    after[:-1] = sep[1:]
    tails = off[1:][off[1:] > 0] - 1
    after[tails] = True
    ends = np.flatnonzero(after & ~sep) + 1
    return starts, ends, np.searchsorted(starts, off)


def mix(x: np.ndarray) -> np.ndarray:
    """Invertible 64-bit finaliser (splitmix64)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


@lru_cache(maxsize=16)
def _byte_codes(seed: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * U64(0x9E3779B97F4A7C15) + U64(seed * 7919 + 1))


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** n modulo 2 ** 64; kept until the end of the task at most."""
    have = _POWERS.get(base)
    if have is None or len(have) <= n:
        have = np.full(n + 1, base, dtype=np.uint64)
        have[0] = 1
        np.cumprod(have, out=have)
        _POWERS[base] = have
    return have


_BASES = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)  # odd, so invertible modulo 2 ** 64


class Runs:
    """Hashes of runs ``[i, j)`` of a sequence of 64-bit codes, by one prefix sum.

    hash(i, j) = sum code[k] * base ** (k - i) modulo 2 ** 64, finalised; equal
    code sequences have equal hashes wherever they stand."""

    def __init__(self, codes: np.ndarray, seed: int = 0):
        base = _BASES[seed]
        n = len(codes)
        self.back = _powers(pow(base, -1, 1 << 64), n)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(codes * _powers(base, n)[:n], out=self.sums[1:])

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return mix((self.sums[j] - self.sums[i]) * self.back[i] + (j - i).astype(np.uint64))


def byte_runs(data: np.ndarray, seed: int = 0) -> Runs:
    return Runs(_byte_codes(seed)[data], seed)


def window_starts(word_off: np.ndarray, n: int) -> np.ndarray:
    """Indexes of all words at which ``n`` words of one text begin."""
    total = int(word_off[-1]) if len(word_off) else 0
    if total < n:
        return np.zeros(0, dtype=np.int64)
    last = np.repeat(word_off[1:], np.diff(word_off))  # end of each word's text
    at = np.arange(total, dtype=np.int64)
    return at[at + n <= last]
