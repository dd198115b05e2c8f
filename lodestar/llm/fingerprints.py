"""Merkle fingerprints of documents, with DataFrame functions only.

A text is cut after blank lines into sections, after line ends into
paragraphs, and after punctuation followed by a space into leaves; a leaf
still longer than ``LONG_LEAF`` characters is cut after bytes of certain
values, so that in text without spaces or punctuation an inserted character
changes the leaves around it only. The cuts keep every byte, so equal roots mean equal texts up to SHA-256.
Each node is the SHA-256 of its children's hashes, and the fingerprint is the
root. Two trees are compared from the root down: equal nodes are not entered,
differing branches give the paragraphs that were edited, and the likeness of
two trees is the Dice share of their leaf hashes (1 for equal texts).

``fingerprint_edits`` pairs each document with its successor in descending
order of (id, hash of the text). This order is cut into ranges at quantiles of
a bounded sample, several per shuffle partition; each range gets one guard
row, the first document of the following range, so the text moves through a
single shuffle and no window spans the table, however the ids are spread.

Defined results: a null text counts as empty (one leaf, the empty string);
null ids come after all others; documents with the same id are ordered by the
hash of their text, falling, then by the text; rows with the same id and text
stand together in one range; one document alone is its own successor; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SECTION_END = r"(?<=\n\n)"
PARAGRAPH_END = r"(?<=\n)"
LEAF_END = r"(?<=[.!?,;:] )"
LONG_LEAF = 256
# Bytes in hex: 24 and more, up to one whose second digit is 5 or F.
CONTENT_LEAF = "(?:[0-9A-F]{2}){24}(?:[0-9A-F][0-46-9A-E])*+[0-9A-F][5F]|(?:[0-9A-F]{2})++"
RANGES_PER_PARTITION = 8
SAMPLE_PER_RANGE = 64


def merkle_leaves(text: Column) -> Column:
    """array<section: array<paragraph: array<leaf hash>>>"""
    def pieces(s):
        return F.when(F.length(s) > LONG_LEAF, F.regexp_extract_all(
            F.hex(F.encode(s, "UTF-8")), F.lit(CONTENT_LEAF), F.lit(0))).otherwise(F.array(s))

    def paragraph(p):
        return F.transform(F.flatten(F.transform(F.split(p, LEAF_END), pieces)), lambda s: F.sha2(s, 256))

    def section(x):
        return F.transform(F.split(x, PARAGRAPH_END), paragraph)

    return F.transform(F.split(text, SECTION_END), section)


def _node(children: Column) -> Column:
    return F.sha2(F.concat_ws("", children), 256)


def paragraph_nodes(leaves: Column) -> Column:
    """array<section: array<paragraph hash>>"""
    return F.transform(leaves, lambda sec: F.transform(sec, _node))


def section_nodes(paragraphs: Column) -> Column:
    return F.transform(paragraphs, _node)


def merkle_root(leaves: Column) -> Column:
    return _node(section_nodes(paragraph_nodes(leaves)))


def differing_paragraphs(a: Column, b: Column) -> Column:
    """Places (section, paragraph) whose nodes differ between two trees given
    by their paragraph nodes; equal sections are not entered."""
    pairs = F.arrays_zip(a.alias("a"), b.alias("b"))

    def inside(pair, i):
        pa, pb = F.coalesce(pair["a"], F.array()), F.coalesce(pair["b"], F.array())
        rows = F.transform(F.arrays_zip(pa.alias("a"), pb.alias("b")), lambda q, j: F.when(
            ~q["a"].eqNullSafe(q["b"]), F.struct(i.alias("section"), j.alias("paragraph"))))
        empty = F.filter(rows, lambda r: F.lit(False))
        return F.when(_node(pa) == _node(pb), empty).otherwise(
            F.filter(rows, lambda r: r.isNotNull()))

    return F.flatten(F.transform(pairs, inside))


def likeness(a: Column, b: Column) -> Column:
    """Dice share of the distinct leaf hashes of two trees, 0 to 1."""
    fa, fb = F.array_distinct(F.flatten(F.flatten(a))), F.array_distinct(F.flatten(F.flatten(b)))
    return 2.0 * F.size(F.array_intersect(fa, fb)) / (F.size(fa) + F.size(fb))


def _order_key() -> Column:
    """Rises with (id, hash of the text); rows without an id come first."""
    place = F.coalesce(F.col("doc_id").cast("decimal(20,0)"), F.lit(str(-(1 << 63) - 1)).cast("decimal(20,0)"))
    tie = F.xxhash64("text").bitwiseAND(F.lit((1 << 60) - 1)).cast("decimal(19,0)")
    return (place * F.lit(1 << 60).cast("decimal(19,0)") + tie).cast("decimal(38,0)")


def _range(key: Column, bounds: list) -> Column:
    """How many of the rising bounds are at or below the key, found among
    groups of bounds, then inside one."""
    size = max(1, int(len(bounds) ** 0.5))

    def constant(values: list) -> Column:  # a literal once the plan is folded
        return F.split(F.lit(",".join(map(str, values))), ",").cast("array<decimal(38,0)>")

    def below(found: Column) -> Column:
        return F.size(F.filter(found, lambda x: x <= key))

    group = below(constant(bounds[::size])) - 1  # the group the key falls in
    inside = F.slice(constant(bounds), F.greatest(group, F.lit(0)) * size + 1, F.lit(size))
    return F.when(group < 0, F.lit(0)).otherwise(group * size + below(inside))


def with_successor(docs: DataFrame) -> DataFrame:
    """(doc_id, text, next_text), the next document in descending order, the
    first after the last."""
    spark = docs.sparkSession
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("key", _order_key())
    n = RANGES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    share = SAMPLE_PER_RANGE * n / max(1, docs.select("doc_id").count())
    found = sorted(r["key"] for r in (d.sample(share, seed=1) if share < 1 else d).select("key").collect())
    bounds = sorted({found[len(found) * i // n] for i in range(1, n)}) if found else []
    # range 0 holds the largest keys
    d = d.withColumn("range", F.lit(len(bounds)) - _range(F.col("key"), bounds) if bounds else F.lit(0))

    # the first document of every range, as a guard behind the range before it
    first = (d.groupBy("range").agg(F.max("key").alias("first_key"))
             .withColumn("for", F.coalesce(
                 F.lag("range").over(Window.orderBy("range")),
                 F.max("range").over(Window.partitionBy()))))
    # one row a range, of which there are 8 for each partition
    guards = (d.alias("d").join(F.broadcast(first.alias("f")), (F.col("d.range") == F.col("f.range"))
                                & (F.col("d.key") == F.col("f.first_key")))
              .groupBy(F.col("f.for").alias("range")).agg(F.min("d.text").alias("text"))
              .select(F.lit(None).cast(d.schema["doc_id"].dataType).alias("doc_id"), "text",
                      F.lit(None).cast("decimal(38,0)").alias("key"), "range", F.lit(True).alias("guard")))
    w = Window.partitionBy("range").orderBy("guard", F.col("key").desc(), "text")
    return (d.withColumn("guard", F.lit(False)).unionByName(guards)
            .withColumn("next_text", F.lead("text").over(w))
            .where(~F.col("guard")).select("doc_id", "text", "next_text"))


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edited text (its last third
    replaced by the beginning of its successor), with the paragraphs in which
    they differ and both trees."""
    n = F.length("text")
    cut = F.floor(n / 3).cast("int")
    d = with_successor(docs).withColumn("edited", F.concat(
        F.expr("substring(text, 1, length(text) - int(floor(length(text) / 3)))"),
        F.expr("substring(next_text, 1, int(floor(length(text) / 3)))")))
    d = d.select("doc_id", n.cast("long").alias("n_chars"), cut.alias("n_cut"),
                 F.sha2("edited", 256).alias("edited_sha256"),
                 merkle_leaves(F.col("text")).alias("tree"),
                 merkle_leaves(F.col("edited")).alias("edited_tree"),
                 merkle_leaves(F.col("next_text")).alias("next_tree"))
    return d.select(
        "doc_id", "n_chars", "edited_sha256",
        merkle_root(F.col("tree")).alias("fingerprint"),
        merkle_root(F.col("edited_tree")).alias("edited_fingerprint"),
        likeness(F.col("tree"), F.col("edited_tree")).alias("near_edited"),
        likeness(F.col("tree"), F.col("next_tree")).alias("near_next"),
        differing_paragraphs(paragraph_nodes(F.col("tree")), paragraph_nodes(F.col("edited_tree")))
        .alias("differing"), "tree", "edited_tree")
