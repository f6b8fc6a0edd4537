"""Word hashes of whole columns of texts, and word-shingle sets as arrays of 64-bit hashes.

Words are found and hashed for many texts at once, by arrays over their bytes; no
table of words is kept.
"""

from __future__ import annotations

import numpy as np

from .tokens import text_slices

U64 = np.uint64

#: The bytes that part words, the space and U+0009..U+000D.
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Bytes of words that are hashed at once, and slices of texts.
STEP = 1 << 20


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


#: A value for each byte at each of 64 places in a word; a word's hash is their sum, scrambled.
_VALUES = mixed(mixed(np.arange(1, 64 * 256 + 1, dtype=U64) * U64(0x9E3779B97F4A7C15)))


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(where words begin, where they end, words before each text and, last, of all)."""
    solid = ~_BLANK[data]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]  # a word ends where its text does
    first[inner] = solid[inner]
    last[inner - 1] = solid[inner - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, words before each text and, last, of all); ``lower`` takes A-Z as a-z."""
    starts, ends, of_text = word_bounds(data, offsets)
    out, lo = np.zeros(len(starts), dtype=U64), 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + STEP, "right")))
        part = data[starts[lo] : ends[hi - 1]]
        part = part[~_BLANK[part]]
        lengths = ends[lo:hi] - starts[lo:hi]
        begin = np.cumsum(lengths) - lengths
        place = np.arange(len(part)) - np.repeat(begin, lengths)
        values = _VALUES[((place & 63) << 8) | (_LOWER[part] if lower else part)]
        if lengths.max() > 64:
            far = place > 63
            values[far] = mixed(values[far] + (place[far] >> 6).astype(U64) * U64(0xD6E8FEB86659FD93))
        out[lo:hi] = mixed(np.add.reduceat(values, begin) + lengths.astype(U64))
        lo = hi
    return out, of_text


def column_hashes(column, lower: bool = False):
    """(row, word hashes) of every row of a string column, in order; null has no words."""
    for lo, data, offsets in text_slices(column, STEP):
        h, at = word_hashes(data, offsets, lower)
        for i in range(len(at) - 1):
            yield lo + i, h[at[i] : at[i + 1]]


def window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """A hash of each window of ``k`` word hashes, in order, put together from windows of powers of two."""
    if len(h) < k:
        return np.zeros(0, dtype=U64)
    out, covered, power, size = None, 0, h, 1
    with np.errstate(over="ignore"):
        join = lambda a, b, m: mixed(a[: len(b)] * U64(0x9E3779B97F4A7C15) + b + U64(m))
        while True:
            if k & size:
                out = power if out is None else join(out, power[covered:], covered + size)
                covered += size
            if covered == k:
                return mixed(out + U64(k))
            power = join(power, power[size:], 2 * size)
            size *= 2


def shingle_sets(column, k: int):
    """(row, sorted distinct hashes of the k-word shingles) of every row; A-Z count as a-z.

    A text of fewer words is one shingle, one without words has none.
    """
    for lo, data, offsets in text_slices(column, STEP):
        h, at = word_hashes(data, offsets, lower=True)
        windows = window_hashes(h, k)
        for i in range(len(at) - 1):
            n = at[i + 1] - at[i]
            if n >= k:
                yield lo + i, np.unique(windows[at[i] : at[i + 1] - k + 1])
            else:
                own = h[at[i] : at[i + 1]]
                yield lo + i, window_hashes(own, n) + U64(n) if n else own


def shingle_set(text: str | None, k: int = 3) -> np.ndarray:
    """The set of one text, as shingle_sets gives it."""
    import pyarrow as pa

    return next(shingle_sets(pa.array([text], pa.string()), k))[1]


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays of distinct values."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = len(b) - 1
    return int((b[at] == a).sum())


def parity(s: np.ndarray, longs: int = 4) -> np.ndarray:
    """Signature of 64 * longs bits: bit i is the parity of the members hashed to i.

    Two signatures differ in at most as many bits as the sets differ in members.
    """
    bits = 64 * longs
    odd = (np.bincount((s >> U64(17)) & U64(bits - 1), minlength=bits) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)
