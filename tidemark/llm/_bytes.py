"""Word bounds and 64-bit hashes of stretches, over the bytes of a text, in numpy."""

from __future__ import annotations

import numpy as np

SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A mixing of 64-bit words (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: A 64-bit number for each byte, the factor of the rolling sum, and its inverse modulo 2**64.
NUMBERS = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
FACTOR = 0x5851F42D4C957F2D
INVERSE = pow(FACTOR, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """FACTOR ** i and its inverse for i < n, kept for the longest text so far up to 4 M bytes."""
    if len(_powers[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        made = []
        for base in (FACTOR, INVERSE):
            x = np.ones(size, dtype=np.uint64)
            x[1:] = base
            made.append(np.multiply.accumulate(x))
        if size > 1 << 22:
            return made[0][:n], made[1][:n]
        _powers[:] = made
    return _powers[0][:n], _powers[1][:n]


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes other than 0x20 and 0x09 to 0x0D."""
    solid = np.empty(len(data) + 2, dtype=bool)
    solid[0] = solid[-1] = False
    np.logical_not(SPACES[data], out=solid[1:-1])
    turns = np.flatnonzero(solid[1:] != solid[:-1])
    return turns[::2], turns[1::2]


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each range."""
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(NUMBERS[data] * up[:-1], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of each n consecutive words' hashes."""
    out = words[: len(words) - n + 1].copy()
    for k in range(1, n):
        out = out * np.uint64(FACTOR) + words[k : len(words) - n + 1 + k]
    return mixed(out)


def window_anchors(grams: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of width grams, joined while the same gram is their anchor: first and end of the window starts, anchor.

    The anchor is the leftmost gram of least hash (32 bits), so windows of equal content have it at the same place.
    """
    count = len(grams) - width + 1
    if count <= 0:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    least = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    span = 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    least = np.minimum(least[:count], least[width - span : width - span + count])
    at = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.concatenate(([0], np.flatnonzero(at[1:] != at[:-1]) + 1))
    return first, np.append(first[1:], count), at[first]
