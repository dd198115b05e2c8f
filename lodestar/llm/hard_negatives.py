"""Hard negatives for contrastive training, by segment summaries.

For every anchor the best rows of its own label are its positives; for every
positive the best rows of other labels whose score lies just under the
positive's are its hard negatives. Scores are integer inner products.

Every vector is stored with the mean and the deviation of its segments, at
several levels (1, 4, 16 ... segments). For a segment of length n,
``n * mean(x) * mean(y) +- n * dev(x) * dev(y)`` encloses the product of the
two segments, so the sums over the segments enclose the score. A row whose
upper bound stays under what an anchor still needs, or whose lower bound lies
over its windows, goes without being scored; the rest is refined level by
level and scored exactly at the end. What an anchor needs rises while the
search runs: a few promising rows are scored exactly at each level.

Rows are dealt by position into shards of bounded bytes, anchors into blocks;
a task gets one block and a few shards, and the partial lists of a block are
merged in a tree. Nothing is broadcast or collected, and no label, id or
vector however frequent gathers in one task.

Defined results: a row whose id, label or vector is null, or whose vector
holds a null or non-finite component, takes no part; vectors are compared
with vectors of their own length; rows with an anchor's id count as the
anchor itself; repeated rows are each ranked, and a repeated anchor is an
anchor each time; ties go to the smaller id; a positive with a negative score
has no negatives (its window is empty); fewer rows than asked give fewer
results; an empty table gives an empty result; other columns are ignored.
Scores are exact while they fit 64-bit integers.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.tables import checkpointed
from lodestar.llm.topk import usable

SHARD_BYTES = 16 << 20
BLOCK_BYTES = 4 << 20
SHARDS_PER_TASK = 1
FAN_IN = 16
LEAST_SEGMENT = 4  # components of the shortest segments
FAN_OUT = 4        # segments a segment is refined into
PROBES = 4         # rows scored early, per row asked for

_PACK = [("part", pa.int64()), ("dim", pa.int32()), ("ids", pa.binary()), ("labels", pa.binary()),
         ("vecs", pa.binary()), ("sums", pa.binary())]
_LIST = [("block", pa.int64()), ("dim", pa.int32()), ("grp", pa.int64()), ("slots", pa.binary()),
         ("ids", pa.binary()), ("scores", pa.binary())]
_FOUND = [("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("rank", pa.int32()),
          ("negative_id", pa.int64()), ("positive_score", pa.int64()), ("negative_score", pa.int64())]


def _ddl(fields) -> str:
    kinds = {pa.int64(): "long", pa.int32(): "int", pa.binary(): "binary"}
    return ", ".join(f"{n} {kinds[t]}" for n, t in fields)


def segment_counts(dim: int) -> list[int]:
    """Segments of each level, from one on; the shortest have LEAST_SEGMENT."""
    out, n = [], 1
    while dim // n >= LEAST_SEGMENT:
        out.append(n)
        n *= FAN_OUT
    return out


def summaries(v: np.ndarray) -> np.ndarray:
    """Per row and level the segments' means, then their deviations, both
    times the root of the segment's length, so that products of two rows'
    summaries are products of whole segments."""
    out = []
    for n in segment_counts(v.shape[1]):
        edges = np.linspace(0, v.shape[1], n + 1).astype(np.int64)
        size = np.diff(edges)
        mean = np.add.reduceat(v, edges[:-1], axis=1) / size
        off = v - np.repeat(mean, size, axis=1)
        dev = np.sqrt(np.add.reduceat(off * off, edges[:-1], axis=1) / size)
        out += [mean * np.sqrt(size), dev * np.sqrt(size)]
    return np.concatenate(out, axis=1) if out else np.zeros((len(v), 0))


class Rows:
    """Vectors of one length, sorted by (label, id), with their summaries."""

    def __init__(self, r: dict):
        self.ids = np.frombuffer(r["ids"], np.int64)
        self.labels = np.frombuffer(r["labels"], np.int64)
        self.vecs = np.frombuffer(r["vecs"]).reshape(len(self.ids), r["dim"])
        sums = np.frombuffer(r["sums"]).reshape(len(self.ids), -1)
        self.levels, at = [], 0
        for n in segment_counts(r["dim"]):
            self.levels.append((sums[:, at:at + n], sums[:, at + n:at + 2 * n]))
            at += 2 * n
        self.norm = math.sqrt(float((self.vecs * self.vecs).sum(1).max(initial=0)))

    def of_label(self, label: int) -> tuple[int, int]:
        return (int(np.searchsorted(self.labels, label)),
                int(np.searchsorted(self.labels, label, "right")))


def _scores(q: Rows, i: int, c: Rows, at: np.ndarray) -> np.ndarray:
    if q.norm * c.norm < 2.0 ** 52:
        return np.rint(c.vecs[at] @ q.vecs[i]).astype(np.int64)
    return c.vecs[at].astype(np.int64) @ q.vecs[i].astype(np.int64)


def _needed(scores: np.ndarray, low: np.ndarray, high: np.ndarray, k: int) -> np.ndarray:
    """Each window's k-th best of ``scores``, or its own lower end."""
    out = low.copy()
    for w in range(len(low)):
        inside = scores[(scores >= low[w]) & (scores <= high[w])]
        if len(inside) >= k:
            out[w] = np.partition(inside, len(inside) - k)[len(inside) - k]
    return out


def search(q: Rows, i: int, c: Rows, at: np.ndarray, low: np.ndarray, high: np.ndarray, k: int):
    """For every window [low, high] the k best rows of ``at`` in it, as
    (window, row, score); ``at`` is in id order within each label."""
    slack = 1e-9 * q.norm * c.norm + 1e-6
    for (cm, cd), (qm, qd) in zip(c.levels, q.levels, strict=True):
        if len(at) <= PROBES * k:
            break
        mid, spread = cm[at] @ qm[i], cd[at] @ qd[i]
        near = np.minimum(mid, float(high.max()))  # what lies over the windows is no better than their top
        probe = at[np.argpartition(near, len(at) - PROBES * k)[len(at) - PROBES * k:]]
        low = np.maximum(low, _needed(_scores(q, i, c, probe), low, high, k))
        at = at[(mid + spread >= float(low.min()) - slack) & (mid - spread <= float(high.max()) + slack)]
    scores = _scores(q, i, c, at)
    order = np.lexsort((c.ids[at], ~scores))
    at, scores = at[order], scores[order]
    window, row, score = [], [], []
    for w in range(len(low)):
        inside = np.flatnonzero((scores >= low[w]) & (scores <= high[w]))[:k]
        window.append(np.full(len(inside), w, np.int64))
        row.append(at[inside])
        score.append(scores[inside])
    return np.concatenate(window), np.concatenate(row), np.concatenate(score)


def _best(slots, ids, scores, k: int):
    """The k best of every slot, in order."""
    order = np.lexsort((ids, ~scores, slots))
    slots, ids, scores = slots[order], ids[order], scores[order]
    keep = np.arange(len(slots)) - np.searchsorted(slots, slots) < k
    return slots[keep], ids[keep], scores[keep]


def _join(found: list) -> list[np.ndarray]:
    return [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (zip(*found) if found else ([], [], []))]


def _positive_lists(q: Rows, c: Rows, k: int):
    low, high = np.array([-(1 << 62)]), np.array([1 << 62])
    found = []
    for i in range(len(q.ids)):
        at = np.arange(*c.of_label(q.labels[i]))
        at = at[c.ids[at] != q.ids[i]]
        _, row, score = search(q, i, c, at, low, high, k)
        found.append((np.full(len(row), i, np.int64), c.ids[row], score))
    return _join(found)


def _negative_lists(q: Rows, c: Rows, k: int, slots, scores, ratio: tuple[int, int]):
    """A slot is a place in the block's list of positives."""
    lows, found = -((-ratio[0] * scores) // ratio[1]), []
    for i in np.unique(slots):
        own = np.flatnonzero((slots == i) & (scores >= lows))
        if not len(own):
            continue
        lo, hi = c.of_label(q.labels[i])
        at = np.concatenate([np.arange(lo), np.arange(hi, len(c.ids))])
        at = at[c.ids[at] != q.ids[i]]
        w, row, score = search(q, i, c, at, lows[own], scores[own], k)
        found.append((own[w], c.ids[row], score))
    return _join(found)


def _table(fields, rows: list[dict]) -> pa.Table:
    return pa.Table.from_pylist(rows, pa.schema(fields))


def _longs(b: bytes | None) -> np.ndarray:
    return np.frombuffer(b or b"", np.int64)


def _pack(scale: float):
    def pack(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        part, dim = (k.as_py() for k in key)
        ids = t["vec_id"].to_numpy().astype(np.int64)
        labels = t["label"].to_numpy().astype(np.int64)
        values = t["vec"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        v = np.floor(values.astype(np.float64) * scale).reshape(len(ids), dim)
        order = np.lexsort((ids, labels))
        return _table(_PACK, [{"part": part, "dim": dim, "ids": ids[order].tobytes(),
                               "labels": labels[order].tobytes(), "vecs": v[order].tobytes(),
                               "sums": summaries(v[order]).tobytes()}])
    return pack


def _tiles(k: int, ratio: tuple[int, int] | None):
    """One block against the shards of a group; positives if there is no ratio."""
    def tiles(key: tuple[pa.Scalar, ...], shards: pa.Table, blocks: pa.Table) -> pa.Table:
        block, grp = (x.as_py() for x in key)
        out = []
        for b in blocks.to_pylist():
            q, found = Rows(b), []
            slots, scores = _longs(b["p_slots"]), _longs(b["p_scores"])
            for i in range(shards.num_rows):
                if shards["dim"][i].as_py() != b["dim"]:
                    continue
                c = Rows(shards.slice(i, 1).to_pylist()[0])
                found.append(_positive_lists(q, c, k) if ratio is None else
                             _negative_lists(q, c, k, slots, scores, ratio))
            slots, ids, scores = _best(*_join(found), k)
            out.append({"block": block, "dim": b["dim"], "grp": grp, "slots": slots.tobytes(),
                        "ids": ids.tobytes(), "scores": scores.tobytes()})
        return _table(_LIST, out)
    return tiles


def _merge(k: int):
    def merge(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        rows = t.to_pylist()
        slots, ids, scores = _best(*_join([tuple(_longs(r[c]) for c in ("slots", "ids", "scores"))
                                           for r in rows]), k)
        return _table(_LIST, [{"block": key[0].as_py(), "dim": key[1].as_py(), "grp": key[2].as_py(),
                               "slots": slots.tobytes(), "ids": ids.tobytes(), "scores": scores.tobytes()}])
    return merge


def _rows_out(key: tuple[pa.Scalar, ...], lists: pa.Table, blocks: pa.Table) -> pa.Table:
    out = []
    for x in lists.to_pylist():
        b = blocks.to_pylist()[0]
        slots, ids, scores = (_longs(x[c]) for c in ("slots", "ids", "scores"))
        anchor = _longs(b["ids"])[_longs(b["p_slots"])[slots]]
        rank = np.arange(len(slots)) - np.searchsorted(slots, slots) + 1
        out.append(pa.table([anchor, _longs(b["p_ids"])[slots], rank.astype(np.int32), ids,
                             _longs(b["p_scores"])[slots], scores], schema=pa.schema(_FOUND)))
    return pa.concat_tables(out) if out else _table(_FOUND, [])


def _packed(df: DataFrame, most: int, scale: float) -> tuple[DataFrame, int]:
    """Rows dealt by position into parts of about ``most`` bytes, one packed
    row for each part and vector length."""
    n = df.agg(F.count("*"), F.coalesce(F.max("dim"), F.lit(0))).first()
    parts = max(1, math.ceil(n[0] * 16 * max(n[1], 16) / most))
    dealt = df.withColumn("part", F.pmod(F.monotonically_increasing_id(), F.lit(parts)))
    return checkpointed(dealt.groupBy("part", "dim").applyInArrow(_pack(scale), _ddl(_PACK))), parts


def _searched(shards: DataFrame, n_shards: int, blocks: DataFrame, n_blocks: int, k: int,
              ratio: tuple[int, int] | None, per_task: int, fan_in: int) -> DataFrame:
    """One list for each block and vector length; per-task tables are bounded
    by the shard number in the key."""
    groups = math.ceil(n_shards / per_task)

    def up_to(n):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    left = shards.withColumn("block", up_to(n_blocks)).withColumn("grp", F.pmod("part", F.lit(groups)))
    right = blocks.withColumnRenamed("part", "block").withColumn("grp", up_to(groups))
    lists = checkpointed(left.groupBy("block", "grp").cogroup(right.groupBy("block", "grp"))
                         .applyInArrow(_tiles(k, ratio), _ddl(_LIST)))
    while groups > 1:
        groups = math.ceil(groups / fan_in)
        lists = lists.withColumn("grp", F.floor(F.col("grp") / fan_in)) \
            .groupBy("block", "dim", "grp").applyInArrow(_merge(k), _ddl(_LIST))
    return lists


def mine(rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 5,
         ratio: tuple[int, int] = (80, 100), scale: float = 256.0, shard_bytes: int = SHARD_BYTES,
         block_bytes: int = BLOCK_BYTES, per_task: int = SHARDS_PER_TASK,
         fan_in: int = FAN_IN) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score) for ``anchors`` against ``rows``, both (vec_id, label, vec
    array<float or double>); a negative scores at least ratio[0] / ratio[1] of
    the positive and no more than it."""
    def clean(df):
        return (df.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vec")))
                .select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                        F.col("vec").cast("array<double>").alias("vec")).withColumn("dim", F.size("vec")))

    shards, n_shards = _packed(clean(rows), shard_bytes, scale)
    blocks, n_blocks = _packed(clean(anchors), block_bytes, scale)
    bare = blocks.withColumns({c: F.lit(None).cast("binary") for c in ("p_slots", "p_ids", "p_scores")})
    first = _searched(shards, n_shards, bare, n_blocks, positives, None, per_task, fan_in)
    known = checkpointed(blocks.join(first.select(
        F.col("block").alias("part"), "dim", F.col("slots").alias("p_slots"), F.col("ids").alias("p_ids"),
        F.col("scores").alias("p_scores")), ["part", "dim"]))
    last = _searched(shards, n_shards, known, n_blocks, negatives, ratio, per_task, fan_in)
    return last.groupBy("block", "dim").cogroup(
        known.select(F.col("part").alias("block"), "dim", "ids", "p_slots", "p_ids", "p_scores")
        .groupBy("block", "dim")).applyInArrow(_rows_out, _ddl(_FOUND))
