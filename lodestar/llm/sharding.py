"""Sharding by balanced label propagation, with counts at most one apart.

Documents of equal text are linked. Every linked document starts in a shard
given by its id; in each round a group's documents move to the shard that
already holds most of it (of equal ones, any by a hash), as far as that shard's
quota allows: what two shards want of each other is swapped, the rest goes into
free room. Rounds go on while the number of documents outside their group's
main shard falls by a tenth; groups still apart then (larger than what is free,
or than a shard) go there whole and the final cut makes the counts equal. A
group is seen through its (group, shard) counts, so neither the links within it nor
its members meet in one task: counting combines map-side, the join of members
to their group's target is a plain join that AQE splits when a group is hot,
and quotas are kept through a histogram of gains with a fixed number of bins.
Documents without links cut no edge wherever they go; they fill what the
linked ones leave free.

Last, documents are laid out by (shard label, slice) and cut into shards of
exactly equal counts. A label's linked documents lie between two halves of
its unlinked ones, so the cut corrects differences, and a cut between two
shards parts one group at most. Rows are dealt to slices by id and text, those
of a large group by id and row number, so neither missing ids nor a hot group
fill a slice; only one row per slice meets in one task to give each slice its
offset.

Law ``rows``: counts differ by at most one. ``grown_shard`` is null under it.

Defined results: a null text has size 1 and links with the empty text (crc 0);
null ids are ordinary rows; repeated rows are linked like other copies; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.tables import checkpointed, uniform

GAIN_BINS = 64
SLICES_PER_PARTITION = 4


def _best(counts: DataFrame, salt: int) -> DataFrame:
    """Per group the shard with most of it; ties are spread by a hash."""
    tie = F.xxhash64("grp", "label", F.lit(salt))
    return (counts.groupBy("grp")
            .agg(F.max(F.struct("n", tie.alias("tie"), "label")).alias("b"))
            .select(F.col("grp").alias("_g"), F.col("b.n").alias("best_n"),
                    F.col("b.label").alias("best")))


def _round(linked: DataFrame, counts: DataFrame, quota: int, salt: int) -> DataFrame:
    """One propagation step over (…, grp, n_grp, label) and its (grp, label, n)."""
    # gain of a move: neighbours in the new shard less those in the old one
    wish = (counts.join(_best(counts, salt), F.col("grp") == F.col("_g"))
            .where(F.col("label") != F.col("best"))
            .select(F.col("_g").alias("_go"), F.col("label").alias("_l"), "best", "n", F.least(
                F.floor(4 * F.log2(F.col("best_n") - F.col("n") + 1.0)).cast("int"),
                F.lit(GAIN_BINS - 1)).alias("bin")))
    moves = wish.groupBy("_l", "best", "bin").agg(F.sum("n").alias("want"))
    # what two shards want of each other is swapped, the rest goes into free room
    flow = moves.groupBy("_l", "best").agg(F.sum("want").alias("flow"))
    back = flow.select(F.col("_l").alias("best"), F.col("best").alias("_l"),
                       F.col("flow").alias("back"))
    load = counts.groupBy(F.col("label").alias("best")).agg(F.sum("n").alias("load"))
    rest = F.col("flow") - F.col("swap")
    room = F.greatest(F.lit(0), F.lit(quota) - F.coalesce("load", F.lit(0)))
    flow = (flow.join(back, ["_l", "best"], "left").join(load, "best", "left")
            .withColumn("swap", F.least("flow", F.coalesce("back", F.lit(0))))
            .withColumn("rest", F.sum(rest).over(Window.partitionBy("best")))
            .select("_l", "best", (F.col("swap") + rest * F.least(F.lit(1.0), room / F.greatest(
                F.lit(1), F.col("rest")))).alias("admitted")))
    above = Window.partitionBy("_l", "best").orderBy(F.col("bin").desc()) \
        .rowsBetween(Window.unboundedPreceding, -1)
    admit = (moves.withColumn("ahead", F.coalesce(F.sum("want").over(above), F.lit(0)))
             .join(flow, ["_l", "best"])
             .select("_l", "best", "bin", F.greatest(F.lit(0.0), F.least(F.lit(1.0), (
                 F.col("admitted") - F.col("ahead")) / F.col("want"))).alias("share")))
    target = wish.join(admit, ["_l", "best", "bin"]).select("_go", "_l", "best", "share")
    moved = linked.join(target, (F.col("grp") == F.col("_go")) & (F.col("label") == F.col("_l")),
                        "left")
    go = uniform(F.col("doc_id"), F.col("row"), F.lit("move"), F.lit(salt)) < F.col("share")
    return moved.withColumn("label", F.when(go, F.col("best")).otherwise(F.col("label"))) \
        .select(*linked.columns)


def _propagate(linked: DataFrame, quota: int, rounds: int | None = None) -> DataFrame:
    """Rounds while the documents outside their group's main shard fall by a
    tenth; then the groups still apart go there whole."""
    salt, before = 0, None
    while True:
        counts = checkpointed(linked.groupBy("grp", "label").agg(F.count("*").alias("n")))
        outside = counts.groupBy("grp").agg((F.sum("n") - F.max("n")).alias("n")) \
            .agg(F.sum("n")).first()[0] or 0
        if not outside:
            return linked
        if salt == rounds or before is not None and 10 * outside > 9 * before:
            break
        linked, before = checkpointed(_round(linked, counts, quota, salt)), outside
        salt += 1
    # only groups that are apart are joined
    apart = _best(counts, salt).join(
        counts.groupBy(F.col("grp").alias("_go")).agg(F.count("*").alias("labels"))
        .where("labels > 1"), F.col("_g") == F.col("_go"), "left_semi").select("_g", "best")
    return checkpointed(linked.join(apart, F.col("grp") == F.col("_g"), "left")
                        .withColumn("label", F.coalesce("best", "label")).select(*linked.columns))


def shard(docs: DataFrame, shards: int = 16, rounds: int | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) per row of
    ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    d = checkpointed(docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit("second"), text).alias("b"),
                 F.octet_length(text).alias("c")).alias("grp"),
        F.monotonically_increasing_id().alias("row")))  # kept by the checkpoint
    total = d.count()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    per_slice = max(1, total // (SLICES_PER_PARTITION * parts))
    n_slices = max(1, -(-total // (shards * per_slice)))

    groups = (d.groupBy("grp").agg(F.count("*").alias("n_grp")).where("n_grp > 1")
              .withColumnRenamed("grp", "_grp"))
    d = checkpointed(d.join(groups, F.col("grp") == F.col("_grp"), "left").drop("_grp")
                     .withColumn("label", F.pmod(F.xxhash64("doc_id", "grp"), F.lit(shards)).cast("int")))
    linked, loose = d.where("n_grp is not null"), d.where("n_grp is null")
    linked = _propagate(linked, -(-total // shards), rounds)

    # unlinked documents fill the quotas; one row per shard is read here
    held = {r["label"]: r["n"] for r in
            linked.groupBy("label").agg(F.count("*").alias("n")).collect()}
    free = [max(0.0, total / shards - held.get(s, 0)) for s in range(shards)]
    whole, upto, pick = sum(free) or 1.0, 0.0, F.lit(0)
    u = uniform(F.col("doc_id"), F.col("grp"), F.lit("fill"))  # unlinked texts differ
    for f in free[:-1]:
        upto += f / whole
        pick = pick + (u >= upto).cast("int")
    loose = (loose.withColumn("label", pick)
             .withColumn("zone", F.when(uniform(F.col("doc_id"), F.col("grp"), F.lit("zone")) < 0.5, 0)
                         .otherwise(2))
             .withColumn("own", F.lit(0).cast("long"))
             .withColumn("slice", F.pmod(F.xxhash64("doc_id", "grp", F.lit("slice")), F.lit(n_slices))))
    large = F.col("n_grp") > per_slice
    pieces = F.ceil(F.col("n_grp") / F.lit(per_slice))
    linked = (linked.withColumn("zone", F.lit(1))
              .withColumn("own", F.when(large, F.col("grp.a")).otherwise(F.lit(0)).cast("long"))
              .withColumn("slice", F.when(large, F.pmod(F.xxhash64("doc_id", "row", F.lit("slice")), pieces))
                          .otherwise(F.pmod(F.col("grp.b"), F.lit(n_slices)))))
    laid = checkpointed(loose.unionByName(linked))

    place = ["label", "zone", "own", "slice"]
    before = Window.orderBy(*place).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (laid.groupBy(*place).agg(F.count("*").alias("n"))
               .withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)))
               .drop("n"))
    inside = Window.partitionBy(*place).orderBy("grp", "doc_id")
    rank = F.col("offset") + F.col("_in") - 1
    n = F.lit(total)
    return (laid.withColumn("_in", F.row_number().over(inside))
            .join(offsets, place).withColumn("rank", rank)
            .withColumn("shard", F.expr(f"int(rank * {shards} div {max(total, 1)})"))
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                    (F.col("rank") - F.floor((F.col("shard").cast("long") * n + (shards - 1))
                                             / F.lit(shards))).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
