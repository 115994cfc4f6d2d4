"""Words of whole Arrow text batches as numpy arrays, and the 64-bit hashes that the operators share.

A word is a longest run of digits, ASCII letters (lower-cased) and characters outside ASCII. All
functions work on the UTF-8 bytes of many texts at once; memory is bounded by the slice size, apart
from a single text that is longer than it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20
ODD = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1


def _word_table() -> np.ndarray:
    table = np.zeros(256, np.uint8)
    for byte in range(256):
        char = chr(byte)
        if byte >= 0x80 or "0" <= char <= "9" or "a" <= char <= "z":
            table[byte] = byte
        elif "A" <= char <= "Z":
            table[byte] = byte + 32
    return table


WORD_BYTES = _word_table()
# For bytes.translate: what is no part of a word becomes a blank.
WORD_TRANSLATION = bytes(int(b) or 32 for b in WORD_BYTES)


class Words(NamedTuple):
    """Words in text order; ``first[i]`` is the number of the first word of text i (one more entry than texts)."""

    start: np.ndarray
    end: np.ndarray
    key: np.ndarray
    first: np.ndarray


def mix(z: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    z = z ^ (z >> np.uint64(30))
    z = z * np.uint64(0xBF58476D1CE4E5B9)
    z = z ^ (z >> np.uint64(27))
    z = z * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(ODD, -1, 1 << 64)
    up, down = np.full(n + 1, ODD, np.uint64), np.full(n + 1, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n (at least) of the hash base and of its inverse modulo 2**64."""
    return _powers(1 << max(16, int(n).bit_length()))


def run_keys(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit keys of the runs values[start:end], equal for equal runs wherever they stand."""
    up, down = powers(len(values))
    total = np.empty(len(values) + 1, np.uint64)
    total[0] = 0
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[: len(values)], out=total[1:])
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch cut so that a slice's texts hold at most ``limit`` bytes; a longer text is its own slice."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    total, at = np.cumsum(lengths.astype(np.int64)), 0
    while at < batch.num_rows:
        base = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, base + limit, "right")))
        yield batch.slice(at, to - at)
        at = to


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, one after the other, and their borders; NULL is the empty text."""
    filled = pc.fill_null(column, "").cast(pa.large_string())
    if not len(filled):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(filled.buffers()[1], np.int64)[filled.offset : filled.offset + len(filled) + 1]
    data = filled.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _chunks(low: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of about SLICE_BYTES that end where a word ends."""
    at, n = 0, len(low)
    while at < n:
        to = min(n, at + SLICE_BYTES)
        while to < n and low[to] and low[to - 1]:
            gap = np.flatnonzero(low[to : to + SLICE_BYTES] == 0)
            to = to + int(gap[0]) if len(gap) else min(n, to + SLICE_BYTES)
        yield at, to
        at = to


def words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """All words of the texts data[offsets[i]:offsets[i + 1]]; words do not cross texts."""
    low = WORD_BYTES[data]
    inside = np.zeros(len(low) + 1, bool)
    inside[:-1] = low != 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    borders = offsets[1:-1]
    begins[borders] |= inside[borders]
    start = np.flatnonzero(begins)
    stop = ~inside
    stop[borders] = True
    ends = np.flatnonzero(stop)
    end = ends[np.searchsorted(ends, start, "right")] if len(start) else start
    parts = []
    for a, b in _chunks(low, offsets):
        i, j = np.searchsorted(start, (a, b))
        parts.append(run_keys(low[a:b], start[i:j] - a, end[i:j] - a))
    key = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return Words(start, end, key, np.searchsorted(start, offsets))


def window_keys(key: np.ndarray, size: int) -> np.ndarray:
    """Order-aware keys of ``size`` consecutive words, one for each word that has enough after it."""
    if len(key) < size:
        return np.zeros(0, np.uint64)
    n = len(key) - size + 1
    out = np.zeros(n, np.uint64)
    for j in range(size):
        out = (out ^ key[j : j + n]) * np.uint64(ODD)
        out ^= out >> np.uint64(29)
    return out


def free_name(name: str, *taken: list[str]) -> str:
    """A column name that none of the tables has; Spark compares names without case."""
    used = {c.lower() for columns in taken for c in columns}
    while name.lower() in used:
        name += "_"
    return name
