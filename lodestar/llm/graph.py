"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.tables import checkpointed

MAX_ROUNDS = 60


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "_u")


def components(edges: DataFrame, max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """(node, component) for every node of the links (u, v): the smallest node
    reachable. A round turns every star towards its smallest node; hubs are
    counted with a map-side combine and joined, never gathered. Raises if it
    has not settled after ``max_rounds``, which grow as the logarithm of the
    longest path."""
    e = checkpointed(edges.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = None
    for _ in range(max_rounds):
        # large star: larger neighbours of a node go to its smallest neighbour
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _least(both).select("_u", F.least("_u", "m").alias("m"))
        large = (both.where("v > u").join(least, F.col("u") == F.col("_u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")))
        large = large.union(least.where("m <> _u").select(F.col("_u").alias("u"),
                                                          F.col("m").alias("v"))).distinct()
        # small star: smaller neighbours go to the smallest of them
        small = _least(large)
        e = checkpointed(large.join(small, F.col("u") == F.col("_u"))
                         .select(F.explode(F.array(
                             F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                             F.struct("u", F.col("m").alias("v")))).alias("p"))
                         .select("p.u", "p.v").where("u <> v").distinct())
        now = e.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40)))).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    members = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    heads = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return members.union(heads)
