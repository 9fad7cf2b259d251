"""Vectorised hashing of words and n-grams over the raw bytes of many documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tessera.llm.common import utf8

_ODD = np.uint64(0x9E3779B97F4A7C15)
#: Bytes whose words are hashed together; bounds temporary arrays (a longer document is taken alone).
CHUNK = 2 << 20

BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (multiply, xor-shift)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    out = np.ones(max(n, 1), np.uint64)
    with np.errstate(over="ignore"):
        np.cumprod(np.full(max(n, 1) - 1, _ODD, np.uint64), dtype=np.uint64, out=out[1:])
    return out


def hash_runs(data: np.ndarray, begin: np.ndarray, end: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """64-bit hash of each run data[begin:end]; ``inside`` marks exactly the bytes of all runs."""
    if not len(begin):
        return np.zeros(0, np.uint64)
    lengths = end - begin
    first = np.cumsum(lengths) - lengths
    values = data[inside].astype(np.uint64) + np.uint64(1)
    within = np.arange(len(values), dtype=np.int64) - np.repeat(first, lengths)
    with np.errstate(over="ignore"):
        values *= _powers(int(lengths.max()))[within]
        return mix(np.add.reduceat(values, first) + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of some documents in order, and the word offsets of the documents."""
    n = len(data)
    counts = np.zeros(len(offsets), np.int64)
    if not n:
        return np.zeros(0, np.uint64), counts
    inside = ~BLANK[data]
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    starts, stops = offsets[:-1], offsets[1:]
    real = stops > starts
    begin[starts[real]] |= inside[starts[real]]
    end[stops[real] - 1] |= inside[stops[real] - 1]
    at = np.flatnonzero(begin)
    hashes = hash_runs(data, at, np.flatnonzero(end) + 1, inside)
    return hashes, np.searchsorted(at, offsets)


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position; length len(hashes) - n + 1, regardless of documents."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        total = np.full(m, np.uint64(n) * np.uint64(0xA24BAED4963EE407), np.uint64)
        factor = np.uint64(1)
        for k in range(n):
            total += hashes[k : k + m] * factor
            factor *= np.uint64(0x9FB21C651E98DF25)
        return mix(total)


def chunks(batch: pa.RecordBatch, text: int, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows (from, to, bytes, offsets) of an Arrow batch whose text has about ``limit`` bytes."""
    data, offsets = utf8(batch.column(text))
    row, n = 0, len(offsets) - 1
    while row < n:
        to = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1)
        yield row, to, data[offsets[row] : offsets[to]], offsets[row : to + 1] - offsets[row]
        row = to
