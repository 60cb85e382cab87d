"""Words and word shingles of whole texts as 64-bit hashes, computed from Arrow's UTF-8 buffers.

A word is ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased. No Python string is made: the hash of a
word is a difference of prefix sums, so a text costs a few numpy passes however long it is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

__all__ = ["Words", "combine", "mix", "shingle_sets", "word_chunks"]

CHUNK_BYTES = 1 << 20  # texts handled at once; a longer text is a chunk of its own
SPAN_BYTES = 1 << 18  # bytes whose prefix sums are held at once
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = np.uint64(0xD6E8FEB86659FD93)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
_IS_ALNUM = np.zeros(256, dtype=bool)
_IS_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values: a bijection, so different values stay different."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def combine(parts: list[np.ndarray]) -> np.ndarray:
    """One hash for each sequence of hashes, order and length included."""
    out = np.full(len(parts[0]), len(parts), dtype=np.uint64)
    for part in parts:
        out = mix(out * _STEP + part)
    return out


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def run(base: int) -> np.ndarray:
        steps = np.full(n, base, dtype=np.uint64)
        steps[0] = 1
        return np.multiply.accumulate(steps)

    return run(_BASE), run(_INVERSE)


def _hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + SPAN_BYTES, "right")))
        lo, hi = int(starts[i]), int(ends[j - 1])
        up, down = _powers(max(SPAN_BYTES, 1 << (hi - lo - 1).bit_length()))
        sums = np.zeros(hi - lo + 1, dtype=np.uint64)
        np.cumsum((data[lo:hi].astype(np.uint64) + np.uint64(1)) * up[: hi - lo], out=sums[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = (sums[e] - sums[s]) * down[s]
        i = j
    return mix(out)


@dataclass
class Words:
    """The words of rows ``first`` to ``last`` (exclusive): ``hashes[bounds[i]:bounds[i + 1]]`` is row ``first + i``."""

    first: int
    last: int
    hashes: np.ndarray
    bounds: np.ndarray

    def rows(self) -> Iterator[tuple[int, np.ndarray]]:
        for i in range(self.last - self.first):
            yield self.first + i, self.hashes[self.bounds[i]:self.bounds[i + 1]]

    def owners(self) -> np.ndarray:
        """The row of every word."""
        return np.repeat(np.arange(self.first, self.last), np.diff(self.bounds))


def word_chunks(texts: pa.Array, chunk_bytes: int = CHUNK_BYTES, bare: bool = False) -> Iterator[Words]:
    """The words of a text column, about a megabyte at a time. A NULL text has none. ``bare``: ASCII marks end words, too."""
    is_word = _IS_ALNUM if bare else _IS_WORD
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None else np.empty(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + chunk_bytes, "right")) - 1)
        lo, hi = int(offsets[first]), int(offsets[last])
        cuts = offsets[first:last + 1] - lo
        low = _LOWER[data[lo:hi]]
        inside = is_word[low]
        begins, stops = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        stops[:-1] &= ~inside[1:]
        edges = cuts[:-1][cuts[:-1] < cuts[1:]]  # first bytes of non-empty rows
        begins[edges] = inside[edges]
        tails = cuts[1:][cuts[:-1] < cuts[1:]] - 1
        stops[tails] = inside[tails]
        starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        yield Words(first, last, _hash_spans(low, starts, ends), np.searchsorted(starts, cuts, "left"))
        first = last


def shingle_sets(words: Words, width: int = 5) -> Iterator[tuple[int, np.ndarray]]:
    """For each row the sorted distinct hashes of its ``width``-word shingles; the whole sequence where it has fewer words."""
    h = words.hashes
    n = max(0, len(h) - width + 1)
    grams = combine([h[i:i + n] for i in range(width)]) if n else np.empty(0, np.uint64)
    for i in range(words.last - words.first):
        lo, hi = int(words.bounds[i]), int(words.bounds[i + 1])
        if hi - lo >= width:
            yield words.first + i, np.unique(grams[lo:hi - width + 1])
        elif hi > lo:
            yield words.first + i, combine([h[k:k + 1] for k in range(lo, hi)])
        else:
            yield words.first + i, np.empty(0, np.uint64)
