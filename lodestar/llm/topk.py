"""Exact top-k search by inner product, in tiles.

Candidates are packed into shards and queries into blocks of bounded size;
each (block, shard) tile is one matrix product, from which every query keeps
its k best; the partial lists of a block are then merged in a tree, a fixed
number of shards at a time, so no task sees more than ``fan_in`` lists. Only
blocks are paired, never rows, and nothing is broadcast or collected.

Scores are integers: components become floor(scale * x), products are exact
in double precision below 2^53 and taken in 64-bit integers above.

Defined results: a vector that is null or holds a null or non-finite
component takes no part, nor does a row without id; vectors are compared with
vectors of their own length; a query is not its own candidate, and rows with
its id count as itself; repeated candidate rows are each ranked; ties go to
the smaller id; fewer candidates than k give fewer rows; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.llm.tables import checkpointed

SCALE = 64.0
SHARD_ROWS = 16384
BLOCK_ROWS = 4096
FAN_IN = 16
STEP = 256  # queries in one product

PACKED = "n int, dim int, part long, ids binary, vecs binary"
LISTS = "block long, dim int, shard long, q binary, n binary, ids binary, scores binary"
FOUND = "query_id long, rank int, vec_id long, score long"


def usable(vec: Column) -> Column:
    """The vector is there and all its components are finite numbers."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vec.isNotNull() & ~bad


def _pack(scale: float):
    def pack(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        part, dim = (k.as_py() for k in key)
        ids = t["vec_id"].to_numpy().astype(np.int64)
        values = t["vec"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        v = np.floor(values.astype(np.float64) * scale).reshape(len(ids), dim)
        order = np.argsort(ids, kind="stable")
        return pa.table({"n": pa.array([len(ids)], pa.int32()), "dim": pa.array([dim], pa.int32()),
                         "part": pa.array([part], pa.int64()),
                         "ids": [ids[order].tobytes()], "vecs": [v[order].tobytes()]})
    return pack


def _best(scores: np.ndarray, own: np.ndarray, k: int) -> np.ndarray:
    """Per row, the columns of the k largest scores (first column on ties);
    columns where ``own`` holds come last. Columns are in id order."""
    n = scores.shape[1]
    k = min(k + 1, n)
    if n == 0:
        return np.zeros((len(scores), 0), np.int64)
    top = int(np.abs(scores).max(initial=0)) + 1
    if top * (n + 1) < 1 << 61:
        mixed = scores * n + (n - 1 - np.arange(n))
        mixed[own] = -(1 << 62)
        cut = np.argpartition(mixed, n - k, axis=1)[:, n - k:] if k < n else \
            np.broadcast_to(np.arange(n), scores.shape)
        order = np.argsort(-np.take_along_axis(mixed, cut, 1), axis=1, kind="stable")
        return np.take_along_axis(cut, order, 1)
    ranked = np.argsort(~scores, axis=1, kind="stable")
    last = np.take_along_axis(own, ranked, 1)
    return np.take_along_axis(ranked, np.argsort(last, axis=1, kind="stable"), 1)[:, :k]


def _tiles(k: int):
    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                dim = r["dim"]
                q = np.frombuffer(r["q_vecs"]).reshape(r["q_n"], dim)
                c = np.frombuffer(r["vecs"]).reshape(r["n"], dim)
                qi, ci = np.frombuffer(r["q_ids"], np.int64), np.frombuffer(r["ids"], np.int64)
                bound = np.abs(q).max(initial=0) * np.abs(c).max(initial=0) * max(dim, 1)
                if bound >= 2.0 ** 53:
                    q, c = q.astype(np.int64), c.astype(np.int64)
                counts, ids, scores = [], [], []
                for s in range(0, len(qi), STEP):
                    x = np.rint(q[s:s + STEP] @ c.T).astype(np.int64) if bound < 2.0 ** 53 \
                        else q[s:s + STEP] @ c.T
                    own = qi[s:s + STEP, None] == ci[None, :]
                    at = _best(x, own, k + int(own.sum(1).max(initial=0)))
                    good = ~np.take_along_axis(own, at, 1)
                    good &= np.cumsum(good, 1) <= k
                    counts.append(good.sum(1))
                    ids.append(ci[at][good])
                    scores.append(np.take_along_axis(x, at, 1)[good])
                yield pa.RecordBatch.from_pylist([{
                    "block": r["block"], "dim": dim, "shard": r["part"], "q": r["q_ids"],
                    "n": np.concatenate(counts).astype(np.int64).tobytes(),
                    "ids": np.concatenate(ids).tobytes(),
                    "scores": np.concatenate(scores).tobytes()}], _schema(LISTS))
    return tiles


def _schema(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in ddl.split(", ")])


def _merged(t: pa.Table, k: int):
    """query ids, counts, candidate ids and scores of the k best per query."""
    rows = t.to_pylist()
    q = np.frombuffer(rows[0]["q"], np.int64)
    pos = np.concatenate([np.repeat(np.arange(len(q)), np.frombuffer(r["n"], np.int64)) for r in rows])
    ids = np.concatenate([np.frombuffer(r["ids"], np.int64) for r in rows])
    scores = np.concatenate([np.frombuffer(r["scores"], np.int64) for r in rows])
    order = np.lexsort((ids, ~scores, pos))
    pos, ids, scores = pos[order], ids[order], scores[order]
    rank = np.arange(len(pos)) - np.searchsorted(pos, pos)
    keep = rank < k
    return q, pos[keep], rank[keep], ids[keep], scores[keep]


def _merge(k: int):
    def merge(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        q, pos, _, ids, scores = _merged(t, k)
        return pa.Table.from_pylist([{
            "block": key[0].as_py(), "dim": key[1].as_py(), "shard": key[2].as_py(),
            "q": q.tobytes(), "n": np.bincount(pos, minlength=len(q)).astype(np.int64).tobytes(),
            "ids": ids.tobytes(), "scores": scores.tobytes()}], _schema(LISTS))
    return merge


def _finish(k: int):
    def finish(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        q, pos, rank, ids, scores = _merged(t, k)
        return pa.table({"query_id": q[pos], "rank": (rank + 1).astype(np.int32),
                         "vec_id": ids, "score": scores})
    return finish


def _packed(v: DataFrame, rows: int, total: int, scale: float) -> tuple[DataFrame, int]:
    """Blocks of about ``rows`` vectors; rows are dealt by position, so an id
    or a vector that is repeated without end fills no block alone."""
    parts = max(1, math.ceil(total / rows))
    dealt = v.withColumn("part", F.pmod(F.monotonically_increasing_id(), F.lit(parts)))
    return dealt.groupBy("part", "dim").applyInArrow(_pack(scale), PACKED), parts


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, scale: float = SCALE,
          shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS,
          fan_in: int = FAN_IN) -> DataFrame:
    """(query_id, rank, vec_id, score) for ``queries`` against ``vectors``,
    both (vec_id, vec array<float or double>)."""
    def clean(df):
        return (df.where(F.col("vec_id").isNotNull() & usable(F.col("vec")))
                .select(F.col("vec_id").cast("long").alias("vec_id"),
                        F.col("vec").cast("array<double>").alias("vec"))
                .withColumn("dim", F.size("vec")))

    c, q = clean(vectors), clean(queries)
    shards, n_shards = _packed(c, shard_rows, c.count(), scale)
    blocks, n_blocks = _packed(q, block_rows, q.count(), scale)
    def up_to(n):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    # block and shard are both in the key, so a block's tiles go to many tasks
    each = shards.withColumn("block", up_to(n_blocks))
    blocks = blocks.select(F.col("part").alias("block"), "dim", F.col("n").alias("q_n"),
                           F.col("ids").alias("q_ids"), F.col("vecs").alias("q_vecs"),
                           up_to(n_shards).alias("part"))
    tiles = each.join(blocks, ["block", "part", "dim"])
    lists = checkpointed(tiles.mapInArrow(_tiles(k), LISTS))
    while n_shards > fan_in:
        n_shards = math.ceil(n_shards / fan_in)
        lists = lists.withColumn("shard", F.floor(F.col("shard") / fan_in)) \
            .groupBy("block", "dim", "shard").applyInArrow(_merge(k), LISTS)
    return lists.groupBy("block", "dim").applyInArrow(_finish(k), FOUND)
