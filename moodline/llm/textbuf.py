"""Whole-column text work on the UTF-8 buffers of Arrow arrays, with numpy.

A *word* is a maximal run of ASCII digits, ASCII letters (lower-cased) and
non-ASCII characters: ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z.
All hashes are 64-bit and depend on content only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from moodline.llm import ships_by_value

ships_by_value(__name__)

CHUNK_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_WORD_BASE = 0xD1342543DE82EF95


def mix(x: np.ndarray) -> np.ndarray:
    """Finalising mix of 64-bit values (bijective)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(base: int, n: int, cache: dict = {}) -> tuple[np.ndarray, np.ndarray]:  # noqa: B006
    """base**i and base**-i modulo 2**64 for i < n; kept per worker process for usual sizes."""
    have = cache.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, CHUNK_BYTES + 2)
        inverse = pow(base, -1, 1 << 64)
        made = []
        for b in (base, inverse):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            made.append(np.multiply.accumulate(p))
        have = tuple(made)
        if size <= 8 * CHUNK_BYTES:
            cache[base] = have
    return have[0][:n], have[1][:n]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and int64 offsets of a string array; nulls count as empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) for runs of whole texts.

    A run holds about ``limit`` bytes; a longer text makes a run of its own.
    """
    if len(column) == 0:
        return
    data, offsets = buffers(column)
    lo, n = 0, len(column)
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


def _byte_tables() -> tuple[np.ndarray, np.ndarray]:
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    is_word = np.zeros(256, bool)
    is_word[48:58] = is_word[97:123] = is_word[65:91] = True
    is_word[128:] = True
    return lower, is_word


_LOWER, _IS_WORD = _byte_tables()


@dataclass
class Words:
    """Words of a run of texts: byte ranges, content hashes, text number, and each text's word range."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    doc: np.ndarray
    first: np.ndarray  # per text: index of its first word; one more entry at the end

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray = _IS_WORD, fold: np.ndarray = _LOWER) -> Words:
    """Words of each text; ``inside`` and ``fold`` (256 entries) name word bytes and how they are folded for hashing."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(none, none, np.zeros(0, np.uint64), none, np.zeros(len(offsets), np.int64))
    inside = inside[data]
    opens = np.empty(n + 1, bool)  # a text starts here
    opens[:] = False
    opens[offsets] = True
    begins, ends = np.zeros(n + 1, bool), np.zeros(n + 1, bool)
    begins[0] = inside[0]
    begins[1:n] = inside[1:] & (~inside[:-1] | opens[1:n])
    ends[1:n] = inside[:-1] & (~inside[1:] | opens[1:n])
    ends[n] = inside[-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends)
    up, down = powers(_BASE, n + 1)
    sums = np.zeros(n + 1, np.uint64)
    value = fold[data].astype(np.uint64)
    value += np.uint64(1)
    value *= up[:n]
    np.cumsum(value, out=sums[1:])
    hashed = mix((sums[end] - sums[start]) * down[start])
    first = np.searchsorted(start, offsets)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(start, end, hashed, doc, first)


def window_hash(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive words (one fewer entry per extra word)."""
    n = len(hashes)
    if n < size:
        return np.zeros(0, np.uint64)
    up, down = powers(_WORD_BASE, n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * up[:n], out=sums[1:])
    return mix((sums[size:] - sums[:-size]) * down[:n - size + 1])


def range_hash(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Hash of the whole word sequence of each text (0 words: a fixed value)."""
    n = len(hashes)
    up, down = powers(_WORD_BASE, n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * up[:n], out=sums[1:])
    return mix((sums[first[1:]] - sums[first[:-1]]) * down[first[:-1]] + np.diff(first).astype(np.uint64))


def byte_ranges(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The byte ranges [start, end) as strings."""
    length = end - start
    offsets = np.zeros(len(start) + 1, np.int64)
    np.cumsum(length, out=offsets[1:])
    at = np.arange(offsets[-1]) - np.repeat(offsets[:-1] - start, length)
    return pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(data[at])).cast(pa.string())
