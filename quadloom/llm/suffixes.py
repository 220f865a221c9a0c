"""Prefix hashes of bytes, and suffix sorting that compares by them.

``Hashes`` holds polynomial prefix hashes modulo 2^64, so the hash of any
substring is one subtraction and one product. Two suffixes are compared by a
binary search for their longest common prefix, in a logarithmic number of
steps. ``order`` sorts suffixes by merging: in each round every suffix finds
its place in the sibling run by binary search, all suffixes at once in numpy.
Equal suffixes are verified by their bytes; where a hash deceived, the sort is
made again with another base.
"""

from __future__ import annotations

from functools import cache

import numpy as np

_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)


@cache
def _powers(base: int, n: int) -> np.ndarray:
    powers = np.full(n, base, np.uint64)
    powers[0] = 1
    return np.multiply.accumulate(powers)


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64; kept for lengths up to the next power of two."""
    return _powers(base, 1 << max(0, n - 1).bit_length())[:n]


class Hashes:
    """Hashes of all substrings of ``raw`` (bytes as uint8)."""

    def __init__(self, raw: np.ndarray, base: int = _BASES[0]):
        n = len(raw)
        self.raw = raw
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * powers(base, n), dtype=np.uint64, out=self.prefix[1:])
        self.back = powers(pow(base, -1, 1 << 64), n + 1)

    def of(self, starts: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return (self.prefix[starts + length] - self.prefix[starts]) * self.back[starts]

    def common(self, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
        """Length of the longest common prefix of the suffixes, ``most`` at most; all have ``most`` bytes."""
        found = np.zeros(len(a), np.int64)
        step = 1 << (most.bit_length() - 1)
        while step:
            fits = found + step <= most
            x = np.where(fits, step, 0)
            same = fits & (self.of(a + found, x) == self.of(b + found, x))
            found[same] += step
            step >>= 1
        return found

    def compare(self, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
        """-1, 0 or 1 as the first ``most`` bytes from a are before, at or behind those from b."""
        result = np.zeros(len(a), np.int8)
        differ = np.flatnonzero(self.of(a, most) != self.of(b, most))
        a, b = a[differ], b[differ]
        common = np.minimum(self.common(a, b, most), most - 1)
        x, y = self.raw[a + common], self.raw[b + common]
        result[differ] = np.where(x < y, -1, np.where(x > y, 1, 0))
        return result


def _merged(hashes: Hashes, starts: np.ndarray, group: np.ndarray, most: int) -> np.ndarray:
    """Order of the suffixes within their groups, which lie together, by rounds of merging."""
    n = len(starts)
    first = np.concatenate([[True], group[1:] != group[:-1]])
    base = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    ends = np.append(np.flatnonzero(first)[1:], n)
    size = np.repeat(np.diff(np.append(np.flatnonzero(first), n)), np.diff(np.concatenate([[0], ends])))
    order = np.arange(n)
    width = 1
    while True:
        at = np.flatnonzero(size > width)
        if not len(at):
            return order
        place = at - base[at]
        block = place // width
        left = block % 2 == 0
        low = base[at] + np.where(left, block + 1, block - 1) * width
        end = base[at] + size[at]
        low, high = np.minimum(low, end), np.minimum(low + width, end)
        begin = low.copy()
        own = starts[order[at]]
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            middle = (low[open_] + high[open_]) // 2
            sign = hashes.compare(starts[order[middle]], own[open_], most)
            # those of the left run come before their equals
            before = (sign < 0) | ((sign == 0) & ~left[open_])
            low[open_[before]] = middle[before] + 1
            high[open_[~before]] = middle[~before]
        passed = low - begin
        target = base[at] + (block - block % 2) * width + place - block * width + passed
        following = order.copy()
        following[target] = order[at]
        order = following
        width *= 2


def order(raw: np.ndarray, starts: np.ndarray, group: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of suffixes within groups by their first ``most`` bytes, and which are equal to the one before.

    ``group`` ascends; every suffix has ``most`` bytes.
    """
    for base in _BASES:
        hashes = Hashes(raw, base)
        found = _merged(hashes, starts, group, most)
        a, b = starts[found[:-1]], starts[found[1:]]
        same = np.zeros(len(starts), bool)
        same[1:] = (group[1:] == group[:-1]) & (hashes.of(a, most) == hashes.of(b, most))
        equal = np.flatnonzero(same)
        a, b = starts[found[equal - 1]], starts[found[equal]]
        if all((raw[a + i] == raw[b + i]).all() for i in range(most)):
            return found, same
    raise RuntimeError("hashes of all bases deceived")
