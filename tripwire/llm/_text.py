"""Vectorised word and n-gram hashing on Arrow string columns.

Every function works on a *slice*: a run of whole documents of one Arrow batch
whose bytes lie in one buffer. A slice is bounded by bytes (one longer document
makes a slice of its own), so memory follows the longest text, not the batch.
Words are found on UTF-8 bytes: all separators used here are ASCII, and ASCII
bytes never occur inside a multi-byte character.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 18
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_GRAM_BASE = 0xD1342543DE82EF95


def separators(kind: str) -> np.ndarray:
    """256 flags: is this byte outside words. ``space``: ``[^\\x20\\x09-\\x0D]+`` are words;
    ``alnum``: runs of ASCII letters, digits and non-ASCII characters are words."""
    flags = np.zeros(256, bool)
    if kind == "space":
        flags[[32, 9, 10, 11, 12, 13]] = True
    else:
        flags[:128] = True
        for lo, hi in ((48, 58), (65, 91), (97, 123)):
            flags[lo:hi] = False
    return flags


def _byte_values(lower: bool) -> np.ndarray:
    values = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
    if lower:
        values[65:91] = values[97:123]
    return values


_VALUES = {lower: _byte_values(lower) for lower in (False, True)}
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i < n (kept for the next slice unless a long text made them large)."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            np.multiply.accumulate(p, out=p)
            out.append(p)
        have = (out[0], out[1])
        if size <= 4 * SLICE_BYTES:
            _POWERS[base] = have
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply), so that every output bit depends on every input bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


@dataclass
class Words:
    """Words of the documents of one slice."""

    data: np.ndarray  # the slice's bytes
    doc: np.ndarray  # document (index within the slice) of each word
    start: np.ndarray  # first byte of each word
    end: np.ndarray  # byte after each word
    first: np.ndarray  # index of each document's first word, and the number of words at the end
    doc_start: np.ndarray  # first byte of each document, and the number of bytes at the end

    def hashes(self, lower: bool = False) -> np.ndarray:
        """A 64-bit hash of each word's bytes (A-Z taken as a-z if ``lower``)."""
        n = len(self.data)
        if not len(self.start):
            return np.zeros(0, np.uint64)
        power, inverse = _powers(_BASE, n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_VALUES[lower][self.data] * power[:n], out=sums[1:])
        return mix((sums[self.end] - sums[self.start]) * inverse[self.start] + (self.end - self.start).astype(np.uint64))


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(lo, hi, bytes, starts)`` for runs of rows lo..hi-1 of a string column (null: empty); starts has hi-lo+1 places."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def find_words(data: np.ndarray, doc_start: np.ndarray, outside: np.ndarray) -> Words:
    """All words of a slice; ``outside`` are the 256 flags of ``separators``."""
    n = len(data)
    filled = np.flatnonzero(np.diff(doc_start))
    inside = ~outside[data]
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    before[doc_start[:-1][filled]] = False
    after[doc_start[1:][filled] - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    first = np.searchsorted(start, doc_start)
    return Words(data, np.repeat(np.arange(len(doc_start) - 1), np.diff(first)), start, end, first, doc_start)


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n values from each place on (len - n + 1 of them; none if fewer)."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    power, inverse = _powers(_GRAM_BASE, len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * power[: len(hashes)], out=sums[1:])
    return mix((sums[n:] - sums[:-n]) * inverse[: len(hashes) - n + 1] + _U(n))


def doc_grams(words: Words, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``(places, hashes)`` of the n-word windows that lie in one document."""
    g = grams(hashes, n)
    places = np.flatnonzero(words.doc[: len(g)] == words.doc[n - 1 :]) if len(g) else np.zeros(0, np.int64)
    return places, g[places]


def shingle_sets(words: Words, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``(bounds, values)``: each document's sorted distinct n-word shingles are ``values[bounds[i]:bounds[i+1]]``.
    A document of fewer words has its whole sequence as its one shingle; one without words has none."""
    places, values = doc_grams(words, hashes, n)
    doc = words.doc[places]
    counts = np.diff(words.first)
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        whole = np.array([grams(hashes[words.first[i] : words.first[i + 1]], int(counts[i]))[0] for i in short], np.uint64)
        doc, values = np.concatenate([doc, short]), np.concatenate([values, whole])
        order = np.argsort(doc, kind="stable")
        doc, values = doc[order], values[order]
    edges = np.searchsorted(doc, np.arange(len(counts) + 1))
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        values[lo:hi].sort()
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (values[1:] != values[:-1])
    doc, values = doc[new], values[new]
    return np.searchsorted(doc, np.arange(len(counts) + 1)), values
