"""Suffix arrays of integer sequences in numpy: Larsson-Sadakane refinement and Kasai's common prefixes."""

from __future__ import annotations

import numpy as np

_LANE = 64


def suffix_array(codes: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order.

    Each round sorts only suffixes whose place is still shared, by the rank of the suffix that begins where
    their sorted prefix ends, so that the sorted depth doubles.
    """
    n = len(codes)
    if not n:
        return np.empty(0, np.int64)
    first, sorted_depth = codes, 1
    if codes.dtype == np.uint8:  # seven bytes at a time, and how many of them there are
        padded, sorted_depth = np.append(codes, np.zeros(7, np.uint8)), 7
        first = np.zeros(n, np.uint64)
        for k in range(7):
            first = (first << np.uint64(8)) | padded[k : k + n]
        first = (first << np.uint64(8)) | np.minimum(np.arange(n, 0, -1), 7).astype(np.uint64)
    array = np.argsort(first, kind="stable")
    keys = first[array]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    rank = np.empty(n, np.int64)
    rank[array] = np.repeat(starts, np.diff(np.append(starts, n)))
    open_ = _shared(np.arange(n), rank[array])
    while len(open_):
        suffixes = array[open_]
        ahead = suffixes + sorted_depth
        after = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        pair = (rank[suffixes].astype(np.uint64) << np.uint64(32)) | after.astype(np.uint64)
        order = np.argsort(pair, kind="stable")
        array[open_], pair = suffixes[order], pair[order]
        fresh = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
        rank[array[open_]] = np.repeat(open_[fresh], np.diff(np.append(fresh, len(open_))))
        open_ = _shared(open_, rank[array[open_]])
        sorted_depth *= 2
    return array


def _shared(slots: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Slots whose rank another slot has too (equal ranks stand together)."""
    same = ranks[1:] == ranks[:-1]
    return slots[np.append(False, same) | np.append(same, False)]


def common_prefixes(codes: np.ndarray, array: np.ndarray, depth: int) -> np.ndarray:
    """For each entry of the suffix array the length, up to `depth`, that it shares with the entry before.

    Kasai's walk in text order: a suffix shares at least one code less than the suffix one to its left. The
    text is cut into lanes of 64 suffixes that walk side by side.
    """
    n = len(codes)
    shared = np.zeros(n, np.int64)
    if n < 2:
        return shared
    before = np.full(n, -1, np.int64)
    before[array[1:]] = array[:-1]
    lanes = np.arange(0, n, _LANE)
    length = np.zeros(len(lanes), np.int64)
    for step in range(_LANE):
        here = lanes + step
        inside = here < n
        here, length = here[inside], np.maximum(length[inside] - 1, 0)
        lanes = lanes[inside]
        other = before[here]
        length[other < 0] = 0
        grow = np.flatnonzero((other >= 0) & (length < depth))
        while len(grow):
            a, b = here[grow] + length[grow], other[grow] + length[grow]
            fits = (a < n) & (b < n)
            equal = fits & (codes[np.minimum(a, n - 1)] == codes[np.minimum(b, n - 1)])
            grow = grow[equal]
            length[grow] += 1
            grow = grow[length[grow] < depth]
        shared[here] = length
    return shared[array]


def equal_prefix_groups(codes: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, group of each entry): entries of a group have their first `depth` codes in common.

    Suffixes shorter than `depth` are in groups of their own.
    """
    array = suffix_array(codes)
    return array, np.cumsum(common_prefixes(codes, array, depth) < depth) - 1
