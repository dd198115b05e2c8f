"""Removal of repeated word windows behind a count-min prefilter.

A window is ``WINDOW`` consecutive words of one document. A first pass sketches
all windows (see ``sketch``). A second pass sends only windows estimated
repeated to an exact grouping by 96 bits of hash: each block of documents
sends a window once, with its first place in the block, so a window that
stands in a third of all documents costs one entry per block. The grouping
returns the first place of each window. In the last pass every window that is
estimated repeated and is not such a first place is a repeat - windows that
were only estimated so are their own first places - and the words it covers
are removed.

Windows are judged on the input. Order is by document id, then place.

Defined results: a null or empty text has no words; documents shorter than a
window lose nothing; a null id comes after all others; rows with the same id
count as the same document, and equal rows are treated alike; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.llm.arrays import U, chunks, mixed, rolled, words
from lodestar.llm.sketch import Repeats, repeats

WINDOW = 20
BLOCK_BYTES = 1 << 22
GROUP_ITEMS = 1 << 20
TEXT_BLOCK_BYTES = 1 << 23
LAST_ID = (1 << 63) - 1

ENTRIES = "bucket int, entries binary"
FIRSTS = "block int, firsts binary"
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _windows(data: np.ndarray, ends: np.ndarray, window: int):
    """(hash, second hash, row, start) of the windows of a chunk, plus its
    words (start, end, first)."""
    h, starts, stops, first = words(data, ends)
    n = len(h) - window + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32), none, none, starts, stops, first
    row = np.repeat(np.arange(len(ends)), np.diff(first))
    whole = np.flatnonzero(row[:n] == row[window - 1:])
    one = mixed(rolled(h, window, 0x9E3779B97F4A7C15)[whole])
    two = mixed(rolled(mixed(h + U(1)), window, 0xC2B2AE3D27D4EB4F)[whole])
    row = row[whole]
    return one, (two >> U(32)).astype(np.uint32), row, whole - first[row], starts, stops, first


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("doc_id").fill_null(LAST_ID).to_numpy(zero_copy_only=False)


def _items(window: int):
    def items(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for _, data, ends in chunks(batch, "text"):
            yield _windows(data, ends, window)[0]
    return items


def _planes(*columns: np.ndarray, level: int = 1) -> bytes:
    """Columns of equal length as compressed byte planes."""
    raw = b"".join(np.ascontiguousarray(
        c.view(np.uint8).reshape(len(c), -1).T).tobytes() for c in columns)
    return len(columns[0]).to_bytes(8, "little") + zstandard.ZstdCompressor(level=level).compress(raw)


def _columns(blob: bytes, *kinds: str) -> list[np.ndarray]:
    n = int.from_bytes(blob[:8], "little")
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[8:]), np.uint8)
    out, at = [], 0
    for k in kinds:
        size = np.dtype(k).itemsize
        out.append(np.ascontiguousarray(raw[at:at + n * size].reshape(size, n).T).view(k).ravel())
        at += n * size
    return out


def _entries(filter_: Repeats, window: int, buckets: int):
    """Per block and bucket, each window estimated repeated with its first place."""
    def flush(held):
        one, two, doc, start = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((start, doc, two, one))
        one, two, doc, start = one[order], two[order], doc[order], start[order]
        new = np.ones(len(one), bool)
        new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        one, two, doc, start = one[new], two[new], doc[new], start[new]
        bucket = (one >> U(32)) * U(buckets) >> U(32)
        edges = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
        made = [(b, _planes(one[x:y], two[x:y], doc[x:y], start[x:y]))
                for b, (x, y) in enumerate(zip(edges, edges[1:])) if y > x]
        for lo in range(0, len(made), 256):
            b, blobs = zip(*made[lo:lo + 256])
            yield pa.RecordBatch.from_arrays(
                [pa.array(b, pa.int32()), pa.array(blobs, pa.binary())], names=["bucket", "entries"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            ids = _ids(batch)
            for rows, data, ends in chunks(batch, "text"):
                one, two, row, start, *_ = _windows(data, ends, window)
                at = np.flatnonzero(filter_.maybe(one))
                held.append((one[at], two[at], ids[rows][row[at]], start[at].astype(np.uint32)))
                size += len(data)
                if size >= BLOCK_BYTES:
                    yield from flush(held)
                    held, size = [], 0
        if held:
            yield from flush(held)
    return run


def _block_of(ids: np.ndarray, blocks: int) -> np.ndarray:
    return np.mod(ids ^ (ids >> 21), blocks)


def block_column(doc_id: Column, blocks: int) -> Column:
    """``_block_of`` as a column."""
    d = F.coalesce(doc_id, F.lit(LAST_ID))
    return F.pmod(d.bitwiseXOR(F.shiftright(d, 21)), F.lit(blocks)).cast("int")


def _firsts(blocks: int):
    """First place of every window of a bucket, dealt to document blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        parts: list = []
        pending = 0

        def fold():
            one, two, doc, start = (np.concatenate(x) for x in zip(*([held] if held else []), *parts))
            order = np.lexsort((start, doc, two, one))
            one, two, doc, start = one[order], two[order], doc[order], start[order]
            new = np.ones(len(one), bool)
            new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
            return one[new], two[new], doc[new], start[new]

        for batch in batches:
            for blob in batch.column("entries"):
                parts.append(_columns(blob.as_py(), "<u8", "<u4", "<i8", "<u4"))
                pending += len(parts[-1][0])
                if pending >= 4 * GROUP_ITEMS:
                    held, parts, pending = fold(), [], 0
        if parts:
            held = fold()
        if held is None:
            return
        _, _, doc, start = held
        block = _block_of(doc, blocks)
        order = np.lexsort((start, doc, block))
        doc, start, block = doc[order], start[order], block[order]
        edges = np.searchsorted(block, np.arange(blocks + 1))
        made = [(b, _planes(doc[x:y], start[x:y]))
                for b, (x, y) in enumerate(zip(edges, edges[1:])) if y > x]
        for lo in range(0, len(made), 256):
            b, blobs = zip(*made[lo:lo + 256])
            yield pa.RecordBatch.from_arrays(
                [pa.array(b, pa.int32()), pa.array(blobs, pa.binary())], names=["block", "firsts"])
    return run


def _covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Mask of the items in [0, n) that spans of ``width`` at ``starts`` cover."""
    step = np.zeros(n + 1, np.int32)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + width, -1)
    return np.cumsum(step[:-1]) > 0


def _removed(filter_: Repeats, window: int, with_text: bool):
    def run(key: tuple[pa.Scalar, ...], docs: pa.Table, firsts: pa.Table) -> pa.Table:
        if firsts.num_rows:
            got = [_columns(b.as_py(), "<i8", "<u4") for b in firsts["firsts"]]
            first_doc, first_at = (np.concatenate(x) for x in zip(*got))
        else:
            first_doc, first_at = np.zeros(0, np.int64), np.zeros(0, np.uint32)
        # places of one document as one sorted key: its rank here, then start
        known = np.unique(first_doc)
        first_key = np.sort(np.searchsorted(known, first_doc) << 32 | first_at.astype(np.int64))
        out = []
        for batch in docs.combine_chunks().to_batches():
            ids, shown = _ids(batch), batch.column("doc_id").to_pylist()
            for rows, data, ends in chunks(batch, "text"):
                one, _, row, start, w0, w1, first = _windows(data, ends, window)
                at = np.flatnonzero(filter_.maybe(one))
                doc = ids[rows][row[at]]
                rank = np.searchsorted(known, doc)
                have = rank < len(known)
                have[have] = known[rank[have]] == doc[have]
                key_ = rank << 32 | start[at]
                place = np.searchsorted(first_key, key_)
                is_first = have & (place < len(first_key))
                is_first[is_first] = first_key[place[is_first]] == key_[is_first]
                bad = at[~is_first]
                gone = _covered(first[row[bad]] + start[bad], window, len(w0))
                kept = np.flatnonzero(~gone)
                lo = np.searchsorted(kept, first)
                n_gone = np.diff(np.concatenate([[0], np.cumsum(gone)])[first])
                raw = data.tobytes()
                for i in range(len(ends)):
                    k = kept[lo[i]:lo[i + 1]]
                    text = b" ".join([raw[a:b] for a, b in zip(w0[k].tolist(), w1[k].tolist())])
                    out.append((shown[rows][i], int(first[i + 1] - first[i]), int(n_gone[i]),
                                hashlib.sha256(text).hexdigest(),
                                text.decode("utf-8", "replace") if with_text else None))
        cols = list(zip(*out)) or [[]] * 5
        kinds = [pa.int64()] * 3 + [pa.string()] * 2
        t = pa.table([pa.array(c, k) for c, k in zip(cols, kinds)],
                     names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])
        return t if with_text else t.drop_columns("kept")
    return run


def remove_repeats(docs: DataFrame, window: int = WINDOW, with_text: bool = True) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept) per row of ``docs``
    (doc_id, text); ``kept``, if asked for, is the text left, its words joined
    by a space."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    n_bytes = d.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_words = n_bytes // 4  # an upper guess; only the sketch's width follows it
    filter_ = repeats(d, _items(window), n_words)
    buckets = max(1, n_words // GROUP_ITEMS)
    blocks = n_bytes // TEXT_BLOCK_BYTES | 1
    firsts = (d.mapInArrow(_entries(filter_, window, buckets), ENTRIES)
              .groupBy("bucket").applyInArrow(_firsts(blocks), FIRSTS))
    return (d.withColumn("block", block_column(F.col("doc_id"), blocks)).groupBy("block").cogroup(firsts.groupBy("block"))
            .applyInArrow(_removed(filter_, window, with_text),
                          RESULT + ", kept string" * with_text))
