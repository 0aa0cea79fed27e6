"""Vectorised words of many texts at once: 64-bit hashes of words and n-grams straight from UTF-8 buffers.

The hash of a word is a polynomial in its bytes with random digits, modulo 2**64, and a final mix; that of an n-gram is a
polynomial in its words' hashes. Two different texts agree by chance about once in 2**60 pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

_K = np.uint64(0x9E3779B97F4A7C1B)  # 3 modulo 8, so that differences of its powers have few trailing zero bits
_MIX = np.uint64(0xC2B2AE3D27D4EB4F)
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
SAME = np.arange(256, dtype=np.uint8)
LOWER = SAME.copy()
LOWER[0x41:0x5B] += 0x20
#: For matching that ignores case and punctuation: all ASCII but letters and digits separates words.
PUNCT = np.array([b < 0x80 and not chr(b).isalnum() for b in range(256)])


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


@lru_cache(maxsize=4)
def _powers(n: int, base: int) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    p[0] = 1
    return np.multiply.accumulate(p)


def powers(n: int, base: int = int(_K)) -> np.ndarray:
    return _powers(1 << max(12, (n - 1).bit_length()), base)[:n]


_DIGITS = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@dataclass
class Words:
    """Words of consecutive texts: hash, first and last byte (exclusive) in buf, and how many each text has."""

    buf: np.ndarray
    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    counts: np.ndarray

    @property
    def ends(self) -> np.ndarray:
        return np.r_[0, np.cumsum(self.counts)]

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all n-grams inside texts, in order, and how many each text has."""
        counts = np.maximum(self.counts - (n - 1), 0)
        return gram_hashes(self.hash, n)[gram_mask(self.counts, n)], counts


def gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each place on, if they exist; 0 rows for fewer words."""
    m = len(h) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(m, np.uint64)
    w = powers(n)
    if n <= 4:
        for j in range(n):
            out += h[j : j + m] * w[j]
        return mix(out)
    two = h[:-1] + h[1:] * w[1]  # doubling: spans of 2, 4, 8 ... words, put together by the bits of n
    spans, size = {1: h, 2: two}, 2
    while size * 2 <= n:
        s = spans[size]
        spans[size * 2] = s[:-size] + s[size:] * powers(size + 1)[size]
        size *= 2
    at = 0
    for size in sorted(spans, reverse=True):
        if at + size <= n:
            out += spans[size][at : at + m] * powers(at + 1)[at]
            at += size
            if at == n:
                break
    return mix(out)


def gram_mask(counts: np.ndarray, n: int) -> np.ndarray:
    """Of the places 0..words-n: whether the n words from there are in one text."""
    total = int(counts.sum())
    m = total - n + 1
    if m <= 0:
        return np.zeros(0, bool)
    left = np.repeat(np.cumsum(counts), counts)[:m] - np.arange(m)  # words from here to the text's end
    return left >= n


def scan(buf: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE, fold: np.ndarray = SAME) -> Words:
    """buf: the texts' bytes; offsets: where each begins, and the end."""
    base = int(offsets[0])
    part, off = buf[base : int(offsets[-1])], offsets - base
    gap = space[part]
    if not len(part):
        none = np.empty(0, np.int64)
        return Words(part, np.empty(0, np.uint64), none, none, np.zeros(len(off) - 1, np.int64))
    begins = ~gap
    begins[1:] &= gap[:-1]
    inner = off[(off > 0) & (off < len(part))]
    begins[inner] = ~gap[inner]
    start = np.flatnonzero(begins)
    stops = gap.copy()  # the byte after each word's last
    stops[1:] &= ~gap[:-1]
    stops[0] = False
    cut = inner[~gap[inner - 1]]
    stops[cut] = True
    end = np.flatnonzero(stops)
    if len(end) < len(start):
        end = np.append(end, len(part))
    counts = np.diff(np.searchsorted(start, off))
    if not len(start):
        return Words(part, np.empty(0, np.uint64), start, end, counts)
    size = end - start
    place = np.arange(len(part), dtype=np.int32)[~gap] - np.repeat(start, size).astype(np.int32)
    digits = _DIGITS[fold[part[~gap]]] * powers(int(size.max()) + 1)[place]
    at = np.r_[0, np.cumsum(size)[:-1]]
    return Words(part, mix(np.add.reduceat(digits, at) + size.astype(np.uint64)), start, end, counts)


def pieces(column: pa.ChunkedArray | pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, buffer, offsets) of runs of texts of about `most` bytes; nulls are empty texts."""
    arrays = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    row = 0
    for a in arrays:
        a = a.cast(pa.large_string())
        if a.null_count:
            a = a.fill_null("")
        if len(a):
            _, offs, data = a.buffers()
            offsets = np.frombuffer(offs, np.int64)[a.offset : a.offset + len(a) + 1]
            buf = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
            at = 0
            while at < len(a):
                to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most)))
                to = min(to, len(a))
                yield row + at, buf, offsets[at : to + 1]
                at = to
        row += len(a)


def all_words(column: pa.ChunkedArray | pa.Array, space: np.ndarray = SPACE, fold: np.ndarray = SAME) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a column's texts, and how many each text has."""
    found = [scan(b, o, space, fold) for _, b, o in pieces(column)]
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate([w.hash for w in found]), np.concatenate([w.counts for w in found])


def shard(h: np.ndarray, n: int) -> np.ndarray:
    """Bucket 0..n-1 of each hash, from its high bits; n is below 2**31."""
    return (((h >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)).astype(np.uint16 if n <= 1 << 16 else np.uint32)
