"""A count-min sketch merged from partition sketches, as a filter of repeats.

Every task counts its items' cells in two rows of the sketch and sends them as
sorted, compressed cell numbers, cut into slabs; one task per slab merges the
partition sketches and keeps one bit per cell and level: counted at least
twice, or as often as further levels ask. An item's level is that of its lower
cell. Cells only ever overestimate, so no repeated item is lost; other items
that pass are for the caller to sort out exactly.

The width follows the number of items up to ``MAX_BITS`` (2 x 2^29 cells, 128
MB), the proven bound of what is broadcast. Beyond about 10^9 items the filter
passes more items, never fewer: results do not depend on it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from lodestar.llm.arrays import U, mixed

MIN_BITS, MAX_BITS = 20, 29
SLAB_BITS = 20
FLUSH_ITEMS = 1 << 22
ROWS = 2
CELLS = "row int, slab int, cells binary"
BITS = "row int, slab int, level int, bits binary"


def sketch_bits(items: int, max_bits: int = MAX_BITS) -> int:
    """log2 of the width: about four cells per item, within the bounds."""
    return min(max_bits, max(MIN_BITS, int(4 * max(items, 1) - 1).bit_length()))


def cells(hashes: np.ndarray, bits: int, row: int) -> np.ndarray:
    h = hashes if row == 0 else mixed(hashes + U(0x632BE59BD9B4E019))
    return (h >> U(64 - bits)).astype(np.uint32)


def pack_rising(values: np.ndarray) -> bytes:
    """Sorted uint32 values as zstd-compressed byte planes of their gaps."""
    gaps = np.diff(values, prepend=np.uint32(0)).astype("<u4")
    planes = gaps.view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack_rising(blob: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    gaps = np.ascontiguousarray(raw.reshape(4, -1).T).view("<u4").ravel()
    return np.cumsum(gaps, dtype=np.int64)


def _slabs(hashes: np.ndarray, bits: int) -> Iterator[tuple[int, int, bytes]]:
    for row in range(ROWS):
        c = np.sort(cells(hashes, bits, row))
        slab = c >> np.uint32(SLAB_BITS)
        edges = np.flatnonzero(np.diff(slab, prepend=slab[:1] + 1))
        for a, b in zip(edges, np.append(edges[1:], len(c))):
            yield row, int(slab[a]), pack_rising(c[a:b] & np.uint32((1 << SLAB_BITS) - 1))


def _count(items_of: Callable, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(held):
            found = list(_slabs(np.concatenate(held), bits))
            for lo in range(0, len(found), 256):
                cols = list(zip(*found[lo:lo + 256]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()),
                     pa.array(cols[2], pa.binary())], names=["row", "slab", "cells"])

        held, n = [], 0
        for batch in batches:
            for h in items_of(batch):
                if len(h):
                    held.append(h)
                    n += len(h)
                if n >= FLUSH_ITEMS:
                    yield from out(held)
                    held, n = [], 0
        if n:
            yield from out(held)
    return run


def _merge(levels: tuple[int, ...]):
    most = max(levels)

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]
            ) -> Iterator[pa.RecordBatch]:
        count = np.zeros(1 << SLAB_BITS, np.int32)
        for batch in batches:
            for blob in batch.column("cells"):
                c = unpack_rising(blob.as_py())
                np.add.at(count, c, 1)
                count[c] = np.minimum(count[c], most)
        pack = zstandard.ZstdCompressor(level=1).compress
        n = len(levels)
        yield pa.RecordBatch.from_arrays(
            [pa.array([key[0].as_py()] * n, pa.int32()), pa.array([key[1].as_py()] * n, pa.int32()),
             pa.array(range(n), pa.int32()),
             pa.array([pack(np.packbits(count >= x).tobytes()) for x in levels], pa.binary())],
            names=["row", "slab", "level", "bits"])
    return run


class Repeats:
    """The merged sketch as one broadcast bit array per level and row,
    compressed on its way and on disk; a worker unpacks it once."""

    _open: tuple[object, list[list[np.ndarray]]] | None = None

    def __init__(self, handle, bits: int):
        self._handle, self._bits = handle, bits

    def _levels(self) -> list[list[np.ndarray]]:
        packed = self._handle.value
        if Repeats._open is None or Repeats._open[0] is not packed:
            Repeats._open = None
            unpack = zstandard.ZstdDecompressor().decompress
            Repeats._open = (packed, [[np.frombuffer(unpack(r), np.uint8) for r in rows]
                                      for rows in packed])
        return Repeats._open[1]

    def release(self) -> None:
        """Drop the executors' copies, once nothing uses the filter any more."""
        self._handle.unpersist()

    def _reached(self, hashes: np.ndarray, level: int) -> np.ndarray:
        rows = self._levels()[level]
        out = np.ones(len(hashes), bool)
        for row in range(ROWS):
            at = np.flatnonzero(out)
            c = cells(hashes[at], self._bits, row)
            out[at] = (rows[row][c >> np.uint32(3)] >> (7 - (c & np.uint32(7))).astype(np.uint8)) & 1 != 0
        return out

    def maybe(self, hashes: np.ndarray) -> np.ndarray:
        """True for items estimated to reach the first level."""
        return self._reached(hashes, 0)

    def level(self, hashes: np.ndarray) -> np.ndarray:
        """How many of the levels each item is estimated to reach."""
        out = np.zeros(len(hashes), np.int8)
        at = np.arange(len(hashes))
        for level in range(len(self._levels())):
            at = at[self._reached(hashes[at], level)]
            out[at] += 1
        return out


def repeats(df: DataFrame, items_of: Callable, items: int, levels: tuple[int, ...] = (2,),
            max_bits: int = MAX_BITS) -> Repeats:
    """Sketch the hashes that ``items_of(batch)`` yields for ``df``; ``levels``
    are rising counts. The broadcast takes len(levels) * 2^(bits - 2) bytes."""
    bits = sketch_bits(items, max_bits)
    slabs = (df.mapInArrow(_count(items_of, bits), CELLS).groupBy("row", "slab")
             .applyInArrow(_merge(levels), BITS))
    size = (1 << SLAB_BITS) >> 3
    found = [[np.zeros((1 << bits) >> 3, np.uint8) for _ in range(ROWS)] for _ in levels]
    for r in slabs.collect():
        part = np.frombuffer(zstandard.ZstdDecompressor().decompress(r["bits"]), np.uint8)
        found[r["level"]][r["row"]][r["slab"] * size:(r["slab"] + 1) * size] = part
    packed = []
    while found:   # one array at a time, so the driver holds few of them twice
        packed.append([zstandard.ZstdCompressor(level=1).compress(a.data) for a in found.pop(0)])
    return Repeats(df.sparkSession.sparkContext.broadcast(packed), bits)
