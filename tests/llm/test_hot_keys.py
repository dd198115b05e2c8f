"""Frequent keys are dealt to many tasks."""

import collections
import math
import random

from pyspark.sql import functions as F

from lodestar.llm import mixing, sharding, topk


def test_rows_without_ids_fill_no_slice(spark, monkeypatch):
    rows = [(None, f"text {i}") for i in range(2000)] + [(None, "same")] * 1000 + [(5, "same")] * 1000
    laid = []
    real = sharding.checkpointed
    monkeypatch.setattr(sharding, "checkpointed", lambda df: laid.append(real(df)) or laid[-1])
    out = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    counts = collections.Counter(r.shard for r in out)
    assert len(out) == 4000 and len(counts) == 16 and set(counts.values()) == {250}
    assert all(sorted(r.slot for r in out if r.shard == s) == list(range(250)) for s in counts)
    sliced = next(df for df in reversed(laid) if "slice" in df.columns)
    most = sliced.groupBy("label", "zone", "own", "slice").count().agg(F.max("count")).first()[0]
    assert most < 400, most


def test_buckets_rise_with_the_key_and_spread_large_keys(spark):
    rng = random.Random(2)
    keys = sorted([rng.expovariate(1) for _ in range(2000)] + [500 * rng.expovariate(1) for _ in range(2000)]
                  + [0.0, 4.0, math.nextafter(4.0, 0), 1e6, 1e300])
    df = spark.createDataFrame([(k,) for k in keys], "k double")
    got = [r.b for r in df.select("k", mixing.key_bucket(F.col("k"), 4096).alias("b")).orderBy("k").collect()]
    assert got == sorted(got)
    large = collections.Counter(b for k, b in zip(keys, got, strict=True) if k > 50)
    assert max(large.values()) < 60


def test_a_hot_source_joins_its_plan_in_many_keys(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("one two three").alias("text"),
                                    F.lit(None).cast("string").alias("source"))
    out = mixing.mix(docs)
    assert out.agg(F.sum("taken")).first()[0] == int(1.5 * 9000)
    assert f"{mixing.SALTS - 1}" in out._jdf.queryExecution().optimizedPlan().toString()


def test_tiles_of_one_block_have_keys_of_their_own(spark):
    rng = random.Random(1)
    rows = [(i, [float(rng.randint(-9, 9)) for _ in range(4)]) for i in range(300)]
    v = spark.createDataFrame(rows, "vec_id long, vec array<double>")
    seen = []
    real = topk.checkpointed
    try:
        topk.checkpointed = lambda df: seen.append(df._jdf.queryExecution().executedPlan().toString()) or real(df)
        got = topk.top_k(v, v.where("vec_id % 20 = 0"), k=3, scale=1.0, shard_rows=20, block_rows=100).collect()
    finally:
        topk.checkpointed = real
    assert "block" in seen[0] and "part" in seen[0].split("Join")[1].split("\n")[0]
    want = []
    for i, q in rows[::20]:
        best = sorted((-sum(a * b for a, b in zip(q, w)), j) for j, w in rows if j != i)[:3]
        want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == want
