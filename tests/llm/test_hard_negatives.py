"""Hard negatives against a brute force over all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.llm import hard_negatives as hn

KIND = "vec_id long, label int, vec array<double>, dim string, part string, ids string"


def brute(rows, anchors, k=5, ratio=(80, 100), scale=256):
    def usable(r):
        return None not in (r[0], r[1], r[2]) and all(x is not None and np.isfinite(x) for x in r[2])

    def whole(r):
        return r[0], r[1], [int(np.floor(scale * x)) for x in r[2]]

    rows = [whole(r) for r in rows if usable(r)]
    out = []
    for a, label, v in (whole(r) for r in anchors if usable(r)):
        found = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), i, m)
                       for i, m, w in rows if i != a and len(w) == len(v))
        for p, i, _ in [f for f in found if f[2] == label][:k]:
            near = [f for f in found if f[2] != label and ratio[0] * -p <= ratio[1] * -f[0] <= ratio[1] * -p]
            out += [(a, i, rank + 1, n[1], -p, -n[0]) for rank, n in enumerate(near[:k])]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c") for r in rows], KIND).repartition(3)


def found(df):
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id",
                                              "positive_score", "negative_score").collect())


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(3)
    centres = rng.normal(0, .3, (6, 24))
    rows = [(i, int(rng.integers(0, 4)), (centres[i % 6] + rng.normal(0, .05, 24)).tolist()) for i in range(240)]
    rows += [(300 + i, i % 3, rows[7][2]) for i in range(40)]          # one vector, many ids
    rows += [rows[9]] * 6 + [(9, 2, rows[12][2])]                      # repeated rows, a shared id
    rows += [(400 + i, i % 2, [float(i), 1.0, -0.5]) for i in range(12)]  # another length
    rows += [(500, 0, []), (501, 0, []), (502, 1, [])]
    rows += [(None, 1, rows[0][2]), (600, None, rows[0][2]), (601, 1, None), (602, 1, [None] * 24),
             (603, 1, [float("nan")] * 24), (604, 1, [float("inf")] * 24)]
    return rows


@pytest.mark.parametrize("shard,block,fan_in", [(1 << 20, 1 << 20, 16), (20_000, 6_000, 2)])
def test_against_brute_force(spark, vectors, shard, block, fan_in):
    anchors = [r for r in vectors if r[0] is not None and r[0] % 5 == 0] + [(9, 2, vectors[9][2])] * 2
    got = hn.mine(frame(spark, vectors), frame(spark, anchors), shard_bytes=shard, block_bytes=block,
                  per_task=2, fan_in=fan_in)
    assert found(got) == brute(vectors, anchors)


def test_empty_tables_and_anchors(spark, vectors):
    none = frame(spark, vectors).limit(0)
    assert found(hn.mine(none, none)) == []
    assert found(hn.mine(frame(spark, vectors), none)) == []
    assert found(hn.mine(none, frame(spark, vectors))) == []


def test_bounds_enclose_scores_and_prune():
    rng = np.random.default_rng(5)
    v = np.floor(rng.normal(0, 60, (8, 64)).repeat(100, 0) + rng.normal(0, 4, (800, 64)))
    s, exact = hn.summaries(v), v @ v.T
    at = 0
    for n in hn.segment_counts(64):
        mid, spread = s[:, at:at + n] @ s[:, at:at + n].T, s[:, at + n:at + 2 * n] @ s[:, at + n:at + 2 * n].T
        assert (mid - spread <= exact + 1e-6).all() and (exact <= mid + spread + 1e-6).all()
        at += 2 * n
    order = np.lexsort((np.arange(800), np.zeros(800)))
    rows = hn.Rows({"ids": np.arange(800).tobytes(), "labels": np.zeros(800, np.int64).tobytes(),
                    "vecs": v[order].tobytes(), "sums": s[order].tobytes(), "dim": 64})
    scored = []
    real, hn._scores = hn._scores, lambda q, i, c, at: scored.append(len(at)) or real(q, i, c, at)
    try:
        _, row, _ = hn.search(rows, 0, rows, np.arange(1, 800), np.array([-(1 << 62)]), np.array([1 << 62]), 5)
    finally:
        hn._scores = real
    assert set(row) == set(np.argsort(-exact[0][1:], kind="stable")[:5] + 1)
    assert sum(scored) < 300  # of 799


def test_registered_query_on_ties(spark):
    rows = [(i * 50, i % 2, [1.0, 0.0, 0.0, 0.0]) for i in range(30)]
    df = frame(spark, rows)
    got = hn.mine(df, df.where(F.col("vec_id") % 100 == 0))
    assert found(got) == brute(rows, [r for r in rows if r[0] % 100 == 0])
