"""Texts cut into spans by content, so that equal windows meet wherever they stand.

A window is ``size`` consecutive units (bytes, words). Its mark is the least hash of the ``gram``-unit
pieces inside it, so equal windows have equal marks. A span is a run of windows with one mark; windows that
occur twice therefore lie in spans with the same mark, and comparing spans of a mark finds them all.
"""

from __future__ import annotations

import numpy as np

_ODD = 0x9E3779B97F4A7C15
_WORD = (1 << 64) - 1
_INVERSE = pow(_ODD, -1, 1 << 64)


#: Powers are kept between texts, for texts of up to so many units.
_KEPT = 1 << 18
_kept: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    if n > _KEPT:
        return _doubled(base, n)
    if base not in _kept or len(_kept[base]) < n:
        _kept[base] = _doubled(base, min(_KEPT, 2 * n + 4096))
    return _kept[base][:n]


def _doubled(base: int, n: int) -> np.ndarray:
    out = np.ones(max(1, n), np.uint64)
    have, factor = 1, base & _WORD
    while have < n:
        step = min(have, n - have)
        out[have : have + step] = out[:step] * np.uint64(factor)
        factor = factor * factor & _WORD
        have += step
    return out[:n]


def scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class Rolling:
    """Hashes of pieces: sums of unit * base ** position, shifted back to position 0."""

    def __init__(self, units: np.ndarray):
        n = len(units)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(units * _powers(_ODD, n), out=self.sums[1:])
        self.back = _powers(_INVERSE, n + 1)

    def grams(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return scramble((self.sums[size:] - self.sums[:n]) * self.back[:n])


def least(values: np.ndarray, size: int) -> np.ndarray:
    """The least of each run of ``size`` values: minima from block starts and from block ends."""
    n = len(values) - size + 1
    if n <= 0:
        return values[:0]
    padded = np.full(-(-len(values) // size) * size, np.uint64(_WORD))
    padded[: len(values)] = values
    blocks = padded.reshape(-1, size)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[:n], ahead[size - 1 : size - 1 + n])


def cut(units: np.ndarray, size: int, gram: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Spans of a text: mark, first window, number of windows, and whether its piece may repeat inside.

    A span has ``most`` windows at most; where a run is longer, spans of one mark follow each other. If a
    window stands twice in a span, the piece its mark is from does so too, and then it stands at the start
    of a window other than the last or at the end of a window other than the first.
    """
    if len(units) < size:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none.astype(bool)
    grams, width = Rolling(units).grams(gram), size - gram + 1
    marks = least(grams, width)
    n = len(marks)
    starts = np.concatenate(([0], np.flatnonzero(marks[1:] != marks[:-1]) + 1))
    counts = np.diff(starts, append=n)
    if counts.max() > most:
        starts = np.concatenate([np.arange(a, a + k, most) for a, k in zip(starts.tolist(), counts.tolist())])
    ends = np.concatenate((starts[1:], [n]))
    left, right = np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64)
    np.cumsum(grams[:n] == marks, out=left[1:])
    np.cumsum(grams[width - 1 :] == marks, out=right[1:])
    inside = (left[ends - 1] > left[starts]) | (right[ends] > right[starts + 1])
    return marks[starts], starts, ends - starts, inside
