"""Signature trees over token sets, and their dual traversal.

A leaf holds a few sets; every node holds the OR of its sets' bitmaps, the
range of their sizes and the most tokens any of them loses to shared bits.
Two nodes are entered only if some pair below them could still be similar:
their size ranges must be close enough and their bitmaps must share enough
bits. Sets already known to be connected are not compared again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BITMAP_BITS = 4096
FAN = 16
WORDS = BITMAP_BITS // 64


class SignatureTree:
    """Levels from the leaves up; node i of a level covers FAN of the one below."""

    def __init__(self, sets: list[np.ndarray]):
        n = len(sets)
        size = np.array([len(s) for s in sets], np.int64)
        bits = np.zeros((n, WORDS), np.uint64)
        for i, s in enumerate(sets):
            b = (s >> np.uint64(64 - 12)).astype(np.int64)
            np.bitwise_or.at(bits[i], b >> 6, np.uint64(1) << (b & 63).astype(np.uint64))
        hidden = size - np.bitwise_count(bits).sum(1)
        self.levels = [(bits, size, size, hidden)]
        while len(self.levels[-1][0]) > 1:
            bits, low, high, hidden = self.levels[-1]
            at = np.arange(0, len(bits), FAN)
            self.levels.append((np.bitwise_or.reduceat(bits, at), np.minimum.reduceat(low, at),
                                np.maximum.reduceat(high, at), np.maximum.reduceat(hidden, at)))

    def possible(self, level: int, other: SignatureTree, x: np.ndarray, y: np.ndarray,
                 percent: int) -> np.ndarray:
        """Mask of the node pairs below which similar sets may stand."""
        out = np.zeros(len(x), bool)
        a, b = self.levels[level], other.levels[level]
        for lo in range(0, len(x), 4096):
            i, j = x[lo:lo + 4096], y[lo:lo + 4096]
            close = (100 * a[2][i] >= percent * b[1][j]) & (100 * b[2][j] >= percent * a[1][i])
            common = np.bitwise_count(a[0][i] & b[0][j]).sum(1).astype(np.int64)
            most = common + np.minimum(a[3][i], b[3][j])
            # J >= t needs an overlap of t / (1 + t) of both sizes together
            need = percent * (a[1][i] + b[1][j])
            out[lo:lo + 4096] = close & ((100 + percent) * most >= need)
        return out


def leaf_pairs(a: SignatureTree, b: SignatureTree, percent: int) -> np.ndarray:
    """Pairs of nodes one level above the sets, by dual traversal from the top."""
    same = a is b
    top = max(len(a.levels), len(b.levels)) - 1
    level_of = [min(top, len(t.levels) - 1) for t in (a, b)]
    # trees of unequal height meet at the lower one's root level
    level = min(level_of)
    x = np.repeat(np.arange(len(a.levels[level][0])), len(b.levels[level][0]))
    y = np.tile(np.arange(len(b.levels[level][0])), len(a.levels[level][0]))
    while True:
        if same:
            x, y = x[x <= y], y[x <= y]
        keep = a.possible(level, b, x, y, percent)
        x, y = x[keep], y[keep]
        if level <= 1:
            return np.stack([x, y], 1)
        level -= 1
        na, nb = len(a.levels[level][0]), len(b.levels[level][0])
        i, j = np.divmod(np.arange(FAN * FAN), FAN)
        x, y = (x[:, None] * FAN + i).ravel(), (y[:, None] * FAN + j).ravel()
        inside = (x < na) & (y < nb)
        x, y = x[inside], y[inside]


def _overlap(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def links(first: list[np.ndarray], second: list[np.ndarray] | None, percent: int
          ) -> Iterator[tuple[int, int]]:
    """Links that connect all similar sets: (i, j) in ``first`` alone, or i in
    ``first`` and j in ``second``. Pairs whose sets are already connected are
    left out; every other similar pair is found."""
    n = len(first)
    a = SignatureTree(first)
    b = a if second is None else SignatureTree(second)
    sets = first if second is None else first + second
    shift = 0 if second is None else n
    label = np.arange(len(sets))
    if len(a.levels) == 1 or len(b.levels) == 1:
        pairs = np.zeros((1, 2), np.int64) if len(a.levels) == len(b.levels) else None
        if pairs is None:
            pairs = np.array([(i, j) for i in range(-(-n // FAN))
                              for j in range(-(-(len(sets) - shift) // FAN))], np.int64)
    else:
        pairs = leaf_pairs(a, b, percent)
    order = np.argsort(np.abs(pairs[:, 0] - pairs[:, 1]), kind="stable")
    for x, y in pairs[order].tolist():
        i = np.arange(x * FAN, min(n, x * FAN + FAN))
        j = np.arange(y * FAN, min(len(sets) - shift, y * FAN + FAN))
        li, lj = label[i], label[j + shift]
        if li[0] == lj[0] and (li == li[0]).all() and (lj == li[0]).all():
            continue
        p, q = np.repeat(i, len(j)), np.tile(j, len(i))
        if shift == 0 and x == y:
            p, q = p[p < q], q[p < q]
        ok = a.possible(0, b, p, q, percent)
        for u, v in zip(p[ok].tolist(), (q[ok] + shift).tolist()):
            if label[u] == label[v]:
                continue
            both = _overlap(sets[u], sets[v])
            if 100 * both >= percent * (len(sets[u]) + len(sets[v]) - both):
                yield u, v - shift
                label[label == label[v]] = label[u]
