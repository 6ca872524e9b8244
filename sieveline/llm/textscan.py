"""Whole Arrow batches of UTF-8 text as numpy arrays: words, hashes and counts without a Python loop per word."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once (one longer document is handled alone).
BLOCK = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_SEED = np.random.default_rng(20240901)
_BYTE = _SEED.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_R = np.uint64(0x9E3779B97F4A7C15)
_R_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_STEPS = _SEED.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Words(NamedTuple):
    start: np.ndarray  # first byte
    end: np.ndarray  # behind the last byte
    doc: np.ndarray  # document within the block
    first: np.ndarray  # for each document its first word's index; one more at the end


def blocks(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = BLOCK) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with their texts' bytes and offsets; a null text has no bytes."""
    for batch in batches:
        a = batch.column(batch.schema.get_field_index(column))
        if not len(a):
            continue
        if not pa.types.is_string(a.type):
            a = a.cast(pa.string())
        if a.null_count:
            a = a.fill_null("")
        buffers = a.buffers()
        at = np.frombuffer(buffers[1], np.int32)[a.offset : a.offset + len(a) + 1].astype(np.int64)
        data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None and buffers[2].size else np.zeros(0, np.uint8)
        i = 0
        while i < len(a):
            j = max(i + 1, int(np.searchsorted(at, at[i] + most, "right")) - 1)
            yield batch.slice(i, j - i), data[at[i] : at[j]], at[i : j + 1] - at[i]
            i = j


def runs(inside: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true bytes; no run crosses a document's end."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.zeros(n + 1, bool)
    edge[at] = True
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:] = inside[:-1]
    after[:-1] = inside[1:]
    before &= ~edge[:n]
    after &= ~edge[1:]
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def words(data: np.ndarray, at: np.ndarray) -> Words:
    start, end = runs(~SPACE[data], at)
    doc = np.searchsorted(at, start, "right") - 1
    return Words(start, end, doc, np.searchsorted(doc, np.arange(len(at))))


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_R, _R_INV):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Rolling:
    """64-bit hashes of any byte ranges of a block, from one running polynomial sum."""

    def __init__(self, data: np.ndarray, fold: np.ndarray = LOWER):
        n = 1 << max(16, int(len(data)).bit_length())
        up, self.down = _powers(n)
        if n > 4 * BLOCK:
            _powers.cache_clear()
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[fold[data]] * up[: len(data)], out=self.sums[1:])

    def raw(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.down[start]

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix(self.raw(start, end) + (end - start).astype(np.uint64))


def hash_words(texts: list[str]) -> np.ndarray:
    """The hash that ``Rolling`` gives each of these strings as a word."""
    raw = [t.encode() for t in texts]
    at = np.cumsum([0, *map(len, raw)])
    return Rolling(np.frombuffer(b"".join(raw), np.uint8))(at[:-1], at[1:])


def shingles(h: np.ndarray, w: Words, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document of each run of ``k`` words; a shorter document's whole sequence is its one."""
    n = np.diff(w.first)
    count = np.where(n >= k, n - k + 1, (n > 0).astype(np.int64))
    doc = np.repeat(np.arange(len(n)), count)
    base = np.cumsum(count) - count
    i = w.first[:-1][doc] + np.arange(len(doc)) - base[doc]
    last = w.first[1:][doc]
    total = np.zeros(len(doc), np.uint64)
    for j in range(k):
        here = i + j < last
        total += np.where(here, h[np.minimum(i + j, max(len(h) - 1, 0))] * _STEPS[j] if len(h) else 0, np.uint64(0)).astype(np.uint64)
    return mix(total), doc


def per_doc(doc: np.ndarray, n: int, weight: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(doc, weight, n)[:n]
