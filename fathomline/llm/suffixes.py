"""Suffix order of a block of bytes up to a given depth, and longest previous and next factors from it."""

from __future__ import annotations

import numpy as np


def suffix_ranks(data: np.ndarray, depth: int) -> tuple[list[tuple[int, np.ndarray]], np.ndarray]:
    """Ranks of all suffixes by their first 8, 16, ... bytes (as ``(length, ranks)``) and by their first ``depth``.

    Prefix doubling: two neighbouring ranks of one length give the rank of twice the length. Past the end there are
    zero bytes; callers compare suffixes only as far as they reach. ``depth`` is 8 or more.
    """
    n = len(data)
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)]).astype(np.uint64)
    key = np.zeros(n, dtype=np.uint64)
    for k in range(8):
        key = key << np.uint64(8) | padded[k:n + k]
    rank = np.unique(key, return_inverse=True)[1].astype(np.int64)
    levels, length = [(8, rank)], 8

    def joined(first, second_at):
        second = np.zeros(n, dtype=np.int64)
        second[:max(0, n - second_at)] = first[second_at:] + 1
        return np.unique(first * (n + 2) + second, return_inverse=True)[1].astype(np.int64)

    while length * 2 <= depth:
        rank = joined(rank, length)
        length *= 2
        levels.append((length, rank))
    return levels, rank if length == depth else joined(rank, depth - length)


def common_lengths(levels, left: np.ndarray, right: np.ndarray, depth: int) -> np.ndarray:
    """Common length, ``depth`` at most and in steps of eight bytes, of suffixes at two arrays of positions."""
    n = len(levels[0][1])
    out = np.zeros(len(left), dtype=np.int64)
    for length, rank in reversed(levels):
        for _ in range(2 if length == levels[-1][0] else 1):
            a, b = left + out, right + out
            inside = (a < n) & (b < n) & (out + length <= depth)
            at = np.flatnonzero(inside)
            out[at[rank[a[at]] == rank[b[at]]]] += length
    return out


def _nearest(positions: np.ndarray, lengths: np.ndarray, smaller: bool) -> np.ndarray:
    """Along the suffix order: the common length with the nearest suffix before that has a smaller (or larger) position.

    ``lengths[r]`` is the common length of the suffixes at ``r - 1`` and ``r``. Everything between an entry and the one
    it points to is on the wrong side, so pointers may jump along pointers.
    """
    n = len(positions)
    value = positions if smaller else -positions
    point = np.arange(-1, n - 1)
    least = lengths.copy()
    active = np.arange(1, n)
    while len(active):
        target = point[active]
        wrong = (target >= 0) & (value[np.maximum(target, 0)] > value[active])
        active, target = active[wrong], target[wrong]
        shorter = np.minimum(least[active], least[target])
        least[active], point[active] = shorter, point[target]
    return np.where(point >= 0, least, 0)


def longest_factors(positions: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Longest previous and longest next factor of each suffix, in suffix order.

    The longest match at an earlier position is with the nearest suffix of a smaller position before or after in
    suffix order; of a later position likewise.
    """
    back = np.concatenate([[0], lengths[:0:-1]]) if len(lengths) else lengths
    mirrored = positions[::-1]
    previous = np.maximum(_nearest(positions, lengths, True), _nearest(mirrored, back, True)[::-1])
    following = np.maximum(_nearest(positions, lengths, False), _nearest(mirrored, back, False)[::-1])
    return previous, following
