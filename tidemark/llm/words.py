"""Words, shingles and their 64-bit hashes for whole Arrow text columns, without a Python loop per word.

A word is a run of bytes other than space and U+0009..U+000D. All arithmetic is modulo 2^64: a word's hash is a
polynomial in random values of its bytes, finished by a bijective mixer; a shingle's hash mixes the hashes of its words
in order. Two different shingles share a hash with a chance of about 2^-64.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64
_RANDOM = np.random.Generator(np.random.PCG64(20240229))
_BASE = U(0x9E3779B97F4A7C15)  # odd, so it has an inverse
_INVERSE = U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTES = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
_FOLDED = _BYTES.copy()
_FOLDED[65:91] = _BYTES[97:123]
_PLACES = _RANDOM.integers(1, 1 << 63, 64, dtype=np.uint64) * U(2) + U(1)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
SLICE = 1 << 20  # bytes hashed at once


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every input bit reaches every output bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the row bounds within them; null counts as empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, bounds, data = column.buffers()
    bounds = np.frombuffer(bounds, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each row the number of words before it (one more at the end)."""
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True  # a word never reaches over the end of its row
    inside = ~IS_SPACE[data]
    before = np.empty(len(data), bool)
    after = np.empty(len(data), bool)
    before[:1], before[1:] = False, inside[:-1]
    after[-1:], after[:-1] = False, inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool) -> np.ndarray:
    """One hash a word; ``fold`` treats A-Z as a-z. Works through slices of about ``SLICE`` bytes."""
    values = _FOLDED if fold else _BYTES
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + SLICE, "right")))
        low, high = int(starts[at]), int(ends[to - 1])
        powers = np.full(high - low, _BASE, np.uint64)
        powers[0] = 1
        powers = np.cumprod(powers)
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(values[data[low:high]] * powers, out=sums[1:])
        first = starts[at:to] - low
        inverse = np.full(high - low, _INVERSE, np.uint64)
        inverse[0] = 1
        inverse = np.cumprod(inverse)
        out[at:to] = (sums[ends[at:to] - low] - sums[first]) * inverse[first]
        at = to
    return mix(out)


def shingle_hashes(hashes: np.ndarray, firsts: np.ndarray, width: int, short: bool):
    """Hashes of all runs of ``width`` words, and for each row the number of runs before it (one more at the end).

    With ``short``, a row of fewer words (but one at least) has its whole sequence as its only run.
    """
    counts = np.diff(firsts)
    total = len(hashes) - width + 1
    runs = np.maximum(counts - (width - 1), 0)
    if total > 0:
        every = np.full(total, U(width), np.uint64)
        for place in range(width):
            every += hashes[place : place + total] * _PLACES[place]
        row = np.repeat(np.arange(len(counts)), runs)
        start = np.arange(int(runs.sum())) - np.repeat(np.cumsum(runs) - runs, runs) + firsts[row]
        every = mix(every[start])
    else:
        every = np.zeros(0, np.uint64)
    if short:
        few = np.flatnonzero((counts > 0) & (counts < width))
        if len(few):
            alone = counts[few].astype(np.uint64)
            for place in range(width - 1):
                has = counts[few] > place
                alone[has] += hashes[firsts[few[has]] + place] * _PLACES[place]
            every = np.insert(every, (np.cumsum(runs) - runs)[few], mix(alone))
            runs = runs.copy()
            runs[few] = 1
    return every, np.concatenate([[0], np.cumsum(runs)])


def shingles(column: pa.Array, width: int, *, fold: bool, short: bool):
    """Hashes of the word runs of each text, and the bounds of each row's runs."""
    data, bounds = buffers(column)
    starts, ends, firsts = spans(data, bounds)
    return shingle_hashes(word_hashes(data, starts, ends, fold), firsts, width, short)


def crc32_text(ids: np.ndarray) -> np.ndarray:
    """crc32 of each number written in decimal."""
    import zlib

    return np.fromiter((zlib.crc32(str(i).encode()) for i in ids), np.int64, len(ids))
