"""64-bit hashes of many substrings of one byte array at a time."""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, np.uint64) << np.uint64(1) | np.uint64(1)
_powers = {_BASE: np.ones(1, np.uint64), _INVERSE: np.ones(1, np.uint64)}


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every input bit over the 64 output bits."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def _power(base: np.uint64, n: int) -> np.ndarray:
    if len(_powers[base]) < n:
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        _powers[base] = np.cumprod(steps, dtype=np.uint64)
    return _powers[base][:n]


class Substrings:
    """Hashes of substrings: equal substrings have equal hashes wherever they stand."""

    def __init__(self, data: np.ndarray):
        self.prefix = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTES[data] * _power(_BASE, len(data)), out=self.prefix[1:])
        self.back = _power(_INVERSE, len(data) + 1)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        length = (ends - starts).astype(np.uint64)
        return mix((self.prefix[ends] - self.prefix[starts]) * self.back[starts] + length * np.uint64(0xD6E8FEB86659FD93))


def segment_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of consecutive segments, which may be empty."""
    total = np.zeros(len(values) + 1, np.int64 if values.dtype.kind in "bui" else np.float64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def is_space(data: np.ndarray) -> np.ndarray:
    return _SPACE[data]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all runs without ASCII white space, and the number of words before each text."""
    word = ~is_space(data)
    edge = np.ones(len(data) + 1, bool)
    edge[offsets] = False  # words end with their text
    starts = np.flatnonzero(word & ~np.append(False, word[:-1] & edge[1:-1])) if len(data) else np.empty(0, np.int64)
    ends = np.flatnonzero(word & ~np.append(word[1:] & edge[1:-1], False)) + 1 if len(data) else np.empty(0, np.int64)
    return starts, ends, np.searchsorted(starts, offsets)


def line_spans(data: np.ndarray, offsets: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and texts of all lines that hold a word, in order. starts: of the words."""
    n = len(offsets) - 1
    feeds = np.flatnonzero(data == 10)
    line_starts = np.concatenate([offsets[:-1], feeds + 1])
    owner = np.concatenate([np.arange(n), np.searchsorted(offsets, feeds, side="right") - 1])
    order = np.lexsort((line_starts, owner))
    line_starts, owner = line_starts[order], owner[order]
    line_ends = np.append(line_starts[1:] - 1, len(data))
    last = np.append(owner[1:] != owner[:-1], True)
    line_ends[last[: len(line_ends)]] = offsets[1:][owner[last[: len(owner)]]]
    filled = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    return line_starts[filled], line_ends[filled], owner[filled]
