"""Vectorised text kernels: words, lines, hashes and shingles straight from Arrow string buffers.

Texts are taken a chunk of whole documents at a time, so that working arrays stay in cache and
memory is bounded by the chunk (or the longest single text), not by the Arrow batch.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

_RANDOM = np.random.default_rng(20240229)
BYTE_CODES = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INVERSE = pow(BASE, -1, 1 << 64)


#: glibc's number for the size from which memory is mapped, and so given back when it is freed.
_MAP_THRESHOLD, _MAP_BYTES = -3, 4 << 20


def tidy(run: Callable) -> Callable:
    """For functions of Arrow batches: workers are kept for later tasks, so what a task freed goes back to the system."""

    @functools.wraps(run)
    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        libc = ctypes.CDLL(None)
        if hasattr(libc, "mallopt"):
            libc.mallopt(_MAP_THRESHOLD, _MAP_BYTES)
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        if hasattr(libc, "malloc_trim"):
            libc.malloc_trim(0)

    return tidied


def byte_set(*spans: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, bool)
    for lo, hi in spans:
        out[lo : hi + 1] = True
    return out


WHITE = byte_set((0x20, 0x20), (0x09, 0x0D))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power_table(name: str, base: int, n: int) -> np.ndarray:
    have = _powers[name]
    if len(have) < n:
        size = -(-n // (1 << 18)) * (1 << 18)
        out = np.full(size, base, np.uint64)
        out[0] = 1
        have = _powers[name] = np.cumprod(out, dtype=np.uint64)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Chunk:
    """Whole documents lo to hi of a batch: their bytes, and each one's offsets in them."""

    lo: int
    hi: int
    data: np.ndarray
    offs: np.ndarray

    @property
    def docs(self) -> int:
        return self.hi - self.lo


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null texts become empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if offsets is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[Chunk]:
    data, offs = buffers(column)
    n, lo = len(offs) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + size, "right")) - 1)
        yield Chunk(lo, hi, data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo])
        lo = hi


def spans(chunk: Chunk, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of non-separator bytes, and the first run of each document."""
    inside = ~separators[chunk.data]
    edge = np.zeros(len(inside) + 1, bool)
    edge[chunk.offs] = True
    start, end = inside.copy(), inside.copy()
    if len(inside):
        start[1:] &= ~inside[:-1] | edge[1:-1]
        end[:-1] &= ~inside[1:] | edge[1:-1]
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, chunk.offs)


def prefix_hash(data: np.ndarray) -> np.ndarray:
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_CODES[data] * _power_table("up", BASE, len(data)), out=total[1:])
    return total


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, equal for equal bytes wherever they stand."""
    return mix(span_sum(prefix, starts, ends))


def span_sum(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """What `span_hash` mixes. Of two spans written as one it is the first one's, and the second one's times `powers` of the first one's length."""
    return (prefix[ends] - prefix[starts]) * _power_table("down", BASE_INVERSE, len(prefix))[starts]


def powers(lengths: np.ndarray) -> np.ndarray:
    return _power_table("up", BASE, int(lengths.max(initial=0)) + 1)[lengths]


def words(chunk: Chunk, separators: np.ndarray = WHITE, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and the first word of each document (one more at the end)."""
    if lower:
        chunk = Chunk(chunk.lo, chunk.hi, LOWER[chunk.data], chunk.offs)
    starts, ends, first = spans(chunk, separators)
    return span_hash(prefix_hash(chunk.data), starts, ends), first


def of_doc(first: np.ndarray) -> np.ndarray:
    """The document of each word."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each word on (those that run out of the array are left out)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j in range(k):
        total *= np.uint64(BASE)
        total += hashes[j : j + n]
    return mix(total)


def whole_hash(hashes: np.ndarray) -> np.uint64:
    """Hash of a word sequence of any length."""
    return windows(hashes, len(hashes))[0]


def shingle_sets(hashes: np.ndarray, first: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """Per document: its distinct k-word shingles, sorted; one of all its words where it has fewer."""
    rolled = windows(hashes, k)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= k:
            yield np.unique(rolled[a : b - k + 1])
        elif b > a:
            yield np.full(1, whole_hash(hashes[a:b]))
        else:
            yield np.zeros(0, np.uint64)


class Counter:
    """Sums weights by 64-bit key in bounded batches: a combiner before the shuffle."""

    def __init__(self, limit: int = 1 << 20):
        self.keys, self.sums = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.more: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting, self.limit = 0, limit

    def add(self, keys: np.ndarray, weights: np.ndarray | None = None) -> None:
        if not len(keys):
            return
        if weights is None:
            keys, weights = np.unique(keys, return_counts=True)
        self.more.append((keys, weights))
        self.waiting += len(keys)
        if self.waiting > max(self.limit, len(self.keys)):
            self.merge()

    def merge(self) -> None:
        if self.more:
            keys = np.concatenate([self.keys, *(k for k, _ in self.more)])
            sums = np.concatenate([self.sums, *(w for _, w in self.more)])
            self.keys, self.sums = sum_by(keys, sums)
            self.more, self.waiting = [], 0

    def result(self) -> tuple[np.ndarray, np.ndarray]:
        self.merge()
        return self.keys, self.sums


def sum_by(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return keys, weights
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[new], np.add.reduceat(weights[order], new)


def per_doc(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of word values by document."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[first[1:]] - total[first[:-1]]


def find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of keys in a sorted table, and which are there."""
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.searchsorted(table, keys)
    at[at == len(table)] = 0
    return at, table[at] == keys
