"""Word splitting and 64-bit hashing over raw UTF-8, vectorised with numpy.

Words are maximal runs of bytes other than space and \\t \\n \\v \\f \\r.
"""

from __future__ import annotations

import numpy as np
from xxhash import xxh64_intdigest

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so powers are invertible mod 2**64
_POWERS = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """The first ``n`` powers of the base modulo 2**64."""
    global _POWERS
    if len(_POWERS) < n:
        size = max(n, 2 * len(_POWERS), 1024)
        p = np.full(size, _BASE, np.uint64)
        p[0] = 1
        _POWERS = np.multiply.accumulate(p)
    return _POWERS[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every bit depends on all bits."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def split_words(buf: np.ndarray, offsets: np.ndarray, between: np.ndarray = SPACE):
    """Byte starts and ends of all words, and the first word of each document.

    ``between`` marks the bytes that belong to no word.
    """
    if len(buf) == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    word = ~between[buf]
    before = np.empty_like(word)
    before[0] = False
    before[1:] = word[:-1]
    after = np.empty_like(word)
    after[-1] = False
    after[:-1] = word[1:]
    inner = offsets[(offsets > 0) & (offsets < len(buf))]
    before[inner] = False
    after[inner - 1] = False
    starts = np.flatnonzero(word & ~before)
    ends = np.flatnonzero(word & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


_LOW = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_LONG_SPAN = 256


def hash_spans(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every span ``codes[start:end]`` of bytes, eight bytes at a time."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    lens = ends - starts
    padded = np.zeros(len(codes) + 8, np.uint8)
    padded[:len(codes)] = codes
    eight = np.ndarray(len(codes) + 1, "<u8", padded, strides=(1,))  # the eight bytes from every place on
    out = mix(eight[starts] & _LOW[np.minimum(lens, 8)]) + lens.astype(np.uint64)
    rest = np.flatnonzero((lens > 8) & (lens <= _LONG_SPAN))
    done = 8
    while len(rest):
        word = eight[starts[rest] + done] & _LOW[np.minimum(lens[rest] - done, 8)]
        out[rest] = mix(out[rest] * _BASE + word)
        done += 8
        rest = rest[lens[rest] > done]
    for i in np.flatnonzero(lens > _LONG_SPAN):
        out[i] = xxh64_intdigest(codes[starts[i]:ends[i]].tobytes())
    return mix(out)


def window_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive word hashes."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    if size <= 8:
        for i, p in enumerate(powers(size)):
            out += h[i:i + n] * p
        return mix(out)
    total = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * powers(len(h)), out=total[1:])
    out = total[size:] - total[:n]
    return mix(out * powers_back(n))


_BACK = np.ones(1, np.uint64)


def powers_back(n: int) -> np.ndarray:
    """The first ``n`` powers of the base's inverse modulo 2**64."""
    global _BACK
    if len(_BACK) < n:
        p = np.full(max(n, 2 * len(_BACK), 1024), np.uint64(pow(int(_BASE), -1, 1 << 64)), np.uint64)
        p[0] = 1
        _BACK = np.multiply.accumulate(p)
    return _BACK[:n]


def smallest(h: np.ndarray, window: int) -> np.ndarray:
    """Position of the smallest of every ``window`` consecutive values; ties go to the leftmost."""
    if len(h) < window:
        return np.zeros(0, np.int64)
    pos = np.arange(len(h))
    size = 1
    while size < window:
        step = min(size, window - size)
        a, b = pos[:len(pos) - step], pos[step:]
        pos = np.where(h[b] < h[a], b, a)
        size += step
    return pos


def minimisers(h: np.ndarray, window: int) -> np.ndarray:
    """Positions that hold the smallest value of some run of ``window`` values, in order."""
    pos = smallest(h, window)
    keep = np.ones(len(pos), bool)
    keep[1:] = pos[1:] != pos[:-1]
    return pos[keep]
