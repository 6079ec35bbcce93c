"""Words and 64-bit word hashes of many texts at once, straight from Arrow buffers.

Text stays UTF-8 bytes. Work goes through the buffer in pieces of ``PIECE`` bytes cut between words,
so memory beyond the word arrays does not depend on the length of a text. A hash is a polynomial over
random byte values modulo 2**64 followed by a mixer; equal words have equal hashes everywhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

PIECE = 1 << 18

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTE_VALUES = np.random.default_rng(20240607).integers(1, 1 << 64, 256, dtype=np.uint64)

ASCII_SPACE = np.zeros(256, bool)
ASCII_SPACE[[0x20, *range(0x09, 0x0E)]] = True
# Letters, digits and every byte of a character beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True

FOLDED = _BYTE_VALUES.copy()
FOLDED[65:91] = FOLDED[97:123]
EXACT = _BYTE_VALUES


class Words(NamedTuple):
    """Word ``i`` is ``data[start[i]:end[i]]``; document ``d`` has words ``first[d]`` to ``first[d + 1]``.

    ``tail`` holds the mark cut off the word's end, or 0.
    """

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray
    tail: np.ndarray


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null has no bytes."""
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type)
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def batches(column: pa.Array, most: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of about ``most`` bytes of text; a longer text has a range of its own."""
    _, offsets = buffers(column)
    begin = 0
    while begin < len(column):
        end = int(np.searchsorted(offsets, offsets[begin] + most, side="right")) - 1
        end = min(max(end, begin + 1), len(column))
        yield begin, end
        begin = end


_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        size = max(n, PIECE * 2)
        tables = []
        for base in (_BASE, _BASE_INVERSE):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            tables.append(np.cumprod(table, dtype=np.uint64))
        _powers = tuple(tables)
    return _powers


def words(column: pa.Array, word_byte: np.ndarray, values: np.ndarray, marks: bytes = b"") -> Words:
    """Maximal runs of bytes marked in ``word_byte`` within each text, hashed by ``values``.

    One of ``marks`` that ends a word after an ASCII letter or digit is cut off.
    """
    data, offsets = buffers(column)
    starts, ends, hashes, tails = [], [], [], []
    is_mark, before_mark = np.zeros(256, bool), ALNUM & (np.arange(256) < 128)
    is_mark[list(marks)] = True
    lo, size = 0, len(data)
    while lo < size:
        hi = min(lo + PIECE, size)
        while hi < size:  # cut at a text boundary or beside a separator
            cut = offsets[np.searchsorted(offsets, hi, side="right") - 1]
            if cut > lo:
                hi = int(cut)
                break
            gaps = np.flatnonzero(~word_byte[data[lo:hi]])
            if len(gaps):
                hi = lo + int(gaps[-1]) + 1
                break
            hi = min(hi + PIECE, size)
        part = data[lo:hi]
        inside = word_byte[part]
        borders = offsets[np.searchsorted(offsets, lo) : np.searchsorted(offsets, hi, side="right")] - lo
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        at = borders[borders < len(part)]
        begins[at] = inside[at]
        closes = inside.copy()
        closes[:-1] &= ~inside[1:]
        at = borders[borders > 0] - 1
        closes[at] = inside[at]
        s, e = np.flatnonzero(begins), np.flatnonzero(closes) + 1
        cut = np.zeros(len(s), np.uint8)
        if marks:
            at = np.flatnonzero((e - s > 1) & is_mark[part[e - 1]])
            at = at[before_mark[part[e[at] - 2]]]
            cut[at] = part[e[at] - 1]
            e[at] -= 1
        tails.append(cut)
        power, inverse = _power_tables(len(part) + 1)
        total = np.empty(len(part) + 1, np.uint64)
        total[0] = 0
        np.cumsum(values[part] * power[: len(part)], dtype=np.uint64, out=total[1:])
        hashes.append(mix((total[e] - total[s]) * inverse[s]))
        starts.append(s + lo)
        ends.append(e + lo)
        lo = hi
    joined = [np.concatenate(x) if x else np.zeros(0, t) for x, t in
              ((starts, np.int64), (ends, np.int64), (hashes, np.uint64), (tails, np.uint8))]
    return Words(data, *joined[:3], np.searchsorted(joined[0], offsets), joined[3])


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words; of the whole sequence when it is shorter."""
    n = len(hashes)
    if n == 0:
        return hashes
    size = min(size, n)
    out = mix(hashes[: n - size + 1] + np.uint64(size))
    for k in range(1, size):
        out = mix(out * np.uint64(0xD6E8FEB86659FD93) + hashes[k : n - size + 1 + k])
    return out
