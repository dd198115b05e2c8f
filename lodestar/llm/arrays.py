"""Numpy helpers over whole Arrow columns of text.

Every function works on the bytes of many documents at once; a document never
matches across its ends.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = (1 << 20) - 1
CHUNK_ROWS = 2048
U = np.uint64


def chunks(batch: pa.RecordBatch, column: str, most: int = CHUNK_BYTES
           ) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """(rows, bytes, ends): runs of rows with about ``most`` bytes of text.

    ``ends`` has the end of each row in the bytes; nulls are empty. A longer
    text is a run of its own, never cut.
    """
    whole = batch.column(column)
    for at in range(0, len(whole), CHUNK_ROWS):
        col = whole.slice(at, CHUNK_ROWS).cast(pa.large_binary()).fill_null(b"")
        n = len(col)
        offs = np.frombuffer(col.buffers()[1], np.int64)[col.offset: col.offset + n + 1]
        data = np.frombuffer(col.buffers()[2] or b"", np.uint8)
        lo = 0
        while lo < n:
            hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + most, "right")) - 1)
            hi = min(hi, n)
            yield slice(at + lo, at + hi), data[offs[lo]:offs[hi]], offs[lo + 1:hi + 1] - offs[lo]
            lo = hi


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: spreads every input bit over the whole word."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def rolled(x: np.ndarray, width: int, factor: int) -> np.ndarray:
    """Polynomial hash of every ``width`` consecutive items, by doubling."""
    out, done, level, size = None, 0, x, 1
    while width:
        if width & 1:
            if out is None:
                out, done = level, size
            else:
                n = min(len(out), max(0, len(level) - done))
                out = out[:n] + U(pow(factor, done, 1 << 64)) * level[done:done + n]
                done += size
        width >>= 1
        if width:
            n = max(0, len(level) - size)
            level = level[:n] + U(pow(factor, size, 1 << 64)) * level[size:size + n]
            size *= 2
    return out


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(factor: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get(factor)
    if have is None or len(have[0]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        both = []
        for f in (factor, pow(factor, -1, 1 << 64)):
            p = np.full(size, f, np.uint64)
            p[0] = 1
            both.append(np.cumprod(p, dtype=np.uint64))
        have = _POWERS[factor] = (both[0], both[1])
    return have


def span_hashes(items: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                factor: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """64-bit hash of each span of ``items`` (uint64), its length included."""
    up, down = _powers(factor, len(items) + 1)
    sums = np.zeros(len(items) + 1, np.uint64)
    np.cumsum(items * up[:len(items)], out=sums[1:])
    h = (sums[ends] - sums[starts]) * down[starts]
    return mixed(h + (ends - starts).astype(np.uint64) * U(0xD6E8FEB86659FD93))


BYTE_CODES = mixed(np.arange(1, 257, dtype=np.uint64))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def words(data: np.ndarray, ends: np.ndarray, lower: bool = False
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end, first) of the words of a chunk; ``first[i]`` is the
    index of row i's first word, with one more at the end."""
    n = len(data)
    if n == 0:
        e = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), e, e, np.zeros(len(ends) + 1, np.int64)
    if lower:
        data = np.where((data >= 65) & (data <= 90), data + 32, data)
    is_word = ~_SPACE[data]
    opens, closes = is_word.copy(), is_word.copy()
    opens[1:] &= ~is_word[:-1]
    closes[:-1] &= ~is_word[1:]
    cut = ends[:-1][(ends[:-1] > 0) & (ends[:-1] < n)]
    opens[cut] = is_word[cut]
    closes[cut - 1] = is_word[cut - 1]
    starts, stops = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    first = np.concatenate([[0], np.searchsorted(starts, ends)]).astype(np.int64)
    return span_hashes(BYTE_CODES[data], starts, stops), starts, stops, first
