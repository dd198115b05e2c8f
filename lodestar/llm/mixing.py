"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document draws an exponential key ``-ln(u) / w`` (``u`` uniform from its
id, ``w`` its quality weight). A source whose target is ``e + f`` times its
size takes ``e`` complete epochs, and then the documents with the smallest
keys until their prefix sum of words reaches the fraction ``f``; the document
on the boundary gives only the words still missing, so a source takes its
target rounded down, exactly.

The prefix sum needs no task that holds a source: keys are cut into monotone
buckets (``key_buckets`` for usual keys, an eighth of it for every doubling of
the large keys that low weights give), words are summed per (source, bucket)
with a map-side combine, and only the one bucket a source's budget ends in is
ranked row by row. Nothing is broadcast by hint; a source's row is repeated
``SALTS`` times for the join with its documents, so a hot source is split.

Defined results: a null text has size 0, a null source is a source of its own
and comes last; size 0 takes 0; repeated rows are separate documents with
equal keys; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.tables import checkpointed, word_count

TARGET_SHARE = 1.5
WEIGHT_CYCLE = (5, 2, 1)
MAX_EPOCHS = 2
KEY_BUCKETS = 4096
LARGE_KEY = 4.0  # of documents of full weight, 2 % have larger ones
SALTS = 64
USUAL_WORD_CHARS = 6.0


def quality_weight(n_chars: Column, size: Column) -> Column:
    """In (0, 1]: falls as the mean word length leaves the usual one, as it
    does in tables of numbers, encoded data and text run together."""
    mean = n_chars / F.greatest(size, F.lit(1))
    return 1.0 / (1.0 + F.abs(mean - USUAL_WORD_CHARS) / USUAL_WORD_CHARS)


def key_bucket(key: Column, buckets: int) -> Column:
    """Rises with the key."""
    usual = F.floor((1 - F.exp(-key)) * buckets)
    large = buckets + F.floor(F.log2(key / LARGE_KEY) * (buckets / 8))
    return F.when(key < LARGE_KEY, usual).otherwise(large).cast("int")


def source_targets(sizes: DataFrame, share: float = TARGET_SHARE,
                   cycle: tuple[int, ...] = WEIGHT_CYCLE,
                   max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, target) from one row per source.

    Targets are ``min(level * weight, max_epochs * size)`` with the one level
    at which they sum to ``share`` of all words: what resharing the excess by
    weight until no target is above its bound ends in. Sources are sorted by
    the level at which they reach their bound; the level is found between the
    running sums. One row per source goes through one task.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    weights = F.array(*[F.lit(float(w)) for w in cycle])
    s = (sizes
         .withColumn("weight", F.element_at(
             weights, (F.row_number().over(by_name) - 1) % len(cycle) + 1))
         .withColumn("bound", F.col("source_size") * float(max_epochs))
         .withColumn("full_at", F.col("bound") / F.col("weight")))
    before = (Window.orderBy("full_at", F.col("source").asc_nulls_last())
              .rowsBetween(Window.unboundedPreceding, -1))
    s = (s.withColumn("budget", F.sum("source_size").over(everything) * share)
         .withColumn("full_before", F.coalesce(F.sum("bound").over(before), F.lit(0.0)))
         .withColumn("weight_left", F.sum("weight").over(everything)
                     - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
         .withColumn("level", (F.col("budget") - F.col("full_before")) / F.col("weight_left")))
    # the level is right at the first source that does not pass its bound
    s = s.withColumn("final", F.min(F.when(F.col("level") <= F.col("full_at"), F.struct(
        "full_at", "level"))).over(everything)["level"])
    target = F.least(F.col("bound"), F.coalesce(F.col("final"), F.lit(float("inf")))
                     * F.col("weight"))
    return s.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, key_buckets: int = KEY_BUCKETS, share: float = TARGET_SHARE,
        cycle: tuple[int, ...] = WEIGHT_CYCLE, max_epochs: int = MAX_EPOCHS,
        keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, size, source_size, target, taken, epochs, key, *keep) per row.

    ``docs``: doc_id, text, source. ``taken`` counts words, repeats included.
    ``u`` comes from the md5 of the id, so reruns and other engines agree.
    """
    size = word_count(F.col("text"))
    u = (F.conv(F.substring(F.md5(F.col("doc_id").cast("string")), 1, 13), 16, 10)
         .cast("double") + 0.5) / float(1 << 52)
    narrow = docs.select("doc_id", "source", size.alias("size"),
                         F.coalesce(F.length("text"), F.lit(0)).alias("_chars"),
                         F.coalesce(u, F.lit(0.5)).alias("_u"), *keep)
    narrow = narrow.withColumn("key", -F.log("_u") / quality_weight(F.col("_chars"), F.col("size")))
    narrow = checkpointed(narrow.select(
        "doc_id", "source", "size", "key", key_bucket(F.col("key"), key_buckets).alias("bucket"),
        F.pmod(F.xxhash64("doc_id", "key", F.monotonically_increasing_id()), F.lit(SALTS)).alias("salt"), *keep))

    hist = checkpointed(narrow.groupBy("source", "bucket").agg(F.sum("size").alias("words")))
    targets = source_targets(
        hist.groupBy("source").agg(F.sum("words").alias("source_size")),
        share, cycle, max_epochs)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    targets = checkpointed(
        targets.withColumn("epochs", F.floor(ratio).cast("long"))
        .withColumn("rest", F.greatest(F.lit(0), F.floor(
            F.col("target") - F.col("epochs") * F.col("source_size"))).cast("long")))

    # the bucket in which each source's rest ends, and the words before it
    upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    h = hist.withColumn("through", F.sum("words").over(upto)).alias("h")
    ends = (h.join(targets.select(F.col("source").alias("_s"), "rest"),
                   F.col("source").eqNullSafe(F.col("_s")))
            .where((F.col("through") > F.col("rest"))
                   & (F.col("through") - F.col("words") <= F.col("rest")))
            .groupBy("_s").agg(F.min(F.struct(
                "bucket", (F.col("through") - F.col("words")).alias("before"))).alias("end")))
    plan = (targets.join(ends, F.col("source").eqNullSafe(F.col("_s")), "left")
            .select(F.col("source").alias("_source"), "source_size", "target", "epochs",
                    "rest", F.col("end.bucket").alias("end_bucket"),
                    F.col("end.before").alias("before"),
                    F.explode(F.array(*[F.lit(i).cast("long") for i in range(SALTS)])).alias("_salt")))

    d = narrow.join(plan, F.col("source").eqNullSafe(F.col("_source")) & (F.col("salt") == F.col("_salt"))) \
        .drop("_source", "_salt", "salt")
    # only rows of the ending bucket are ranked; the rest pass straight through
    at_end = d.where(F.col("bucket") == F.col("end_bucket"))
    running = (Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size")
               .rowsBetween(Window.unboundedPreceding, -1))
    left = F.col("rest") - F.col("before") - F.coalesce(F.sum("size").over(running), F.lit(0))
    at_end = at_end.withColumn("part", F.greatest(F.lit(0), F.least(F.col("size"), left)))
    others = (d.where(F.col("end_bucket").isNull() | (F.col("bucket") != F.col("end_bucket")))
              .withColumn("part", F.when(F.col("bucket") < F.col("end_bucket"), F.col("size"))
                          .otherwise(0)))
    return others.unionByName(at_end).select(
        "doc_id", "size", "source_size", F.col("target").cast("double").alias("target"),
        (F.col("epochs") * F.col("size") + F.col("part")).cast("long").alias("taken"),
        "epochs", "key", *keep)
