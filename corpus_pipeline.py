"""From raw documents to packed sequences, five operators in a row.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor
kept, and its result is written as Parquet and read again as the next one's
``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestar.llm import jaccard, language, mixing, suffix_dedup
from lodestar.llm.queries import packed
from lodestar.llm.tables import WORD, small_batches, stored, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
SURE = 0.5  # cosine of a prediction that outweighs a label; short texts stay below


def _documents(df: DataFrame, text: str = "text") -> DataFrame:
    """The columns of ``documents``, with the length of the text as it is now."""
    return df.select("doc_id", F.col(text).alias("text"), "lang", "source",
                     F.length(text).cast("long").alias("n_chars"))


def _text_key(*more: Column) -> list[Column]:
    """With the id, names a row up to repeated rows."""
    return [F.xxhash64("text", *more).alias("_t1"),
            F.xxhash64(F.lit("second"), "text", *more).alias("_t2")]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str,
                languages: tuple[str, ...] | None = None, least: float = 0.0,
                sure: float = SURE) -> DataFrame:
    """Rejects documents without a text or a letter, those predicted with a
    score of ``sure`` or more to be in another language than their label says,
    those predicted to be in none of ``languages`` (as they come: every
    language that is labelled) and those with a score under ``least``. A
    missing label, or one that nothing was learned of, is not contradicted.
    Where nothing is labelled, letters decide alone. Rows without an id are
    documents like others."""
    small_batches(spark)
    d = docs.select(*COLUMNS)
    prototypes = language.fit(d.where(~language.held_out(F.col("doc_id"))))
    if not prototypes:
        return _documents(d.where(F.col("text").rlike(r"\p{L}")))
    found = language.predict(d, prototypes, "doc_id", "lang", "source", with_text=True)
    other = F.col("lang").isin(*prototypes) & (F.col("lang_pred") != F.col("lang"))
    wanted = ((F.col("lang_pred") != language.UNKNOWN)
              & ~F.coalesce(other & (F.col("score") >= sure), F.lit(False)))
    if languages is not None:
        wanted &= F.col("lang_pred").isin(*languages)
    return _documents(found.where(wanted & (F.col("score") >= least)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the smallest id
    (none comes last), then the smallest hash of its text. Different texts
    under one id, or without an id, are documents of their own; texts without
    words all stay."""
    small_batches(spark)
    d = docs.select(*COLUMNS, *_text_key())
    rows = jaccard.groups(d, keep=("_t1", "_t2"))
    key = ("none", "id", "_t1", "_t2")  # without nulls, so that rows are dealt once for join and window
    named = {"none": F.isnull("doc_id"), "id": F.coalesce("doc_id", F.lit(0))}
    rows = rows.withColumns(named)
    first = (rows.where("group is not null").groupBy("group").agg(F.min(F.struct(*key)).alias("k"))
             .select("k.*", F.lit(False).alias("every")))
    bare = rows.where("group is null").select(*key, F.lit(True).alias("every")).distinct()
    met = d.withColumns(named).join(first.unionByName(bare), list(key))
    copy = F.row_number().over(Window.partitionBy(*key).orderBy("source", "lang"))
    return _documents(met.withColumn("copy", copy).where("copy = 1 or every"))


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out every string of 50 bytes that an earlier document has; a
    document of nothing else goes."""
    small_batches(spark)
    cut = suffix_dedup.remove_repeats(docs, keep=("lang", "source"))
    return _documents(cut.where(F.col("kept").rlike(WORD) | (F.col("n_removed") == 0)), "kept")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; the one on the boundary of
    its source gives its first words. Of repeated rows the mix takes the first
    ones whole."""
    small_batches(spark)
    key = ("doc_id", "_t1", "_t2")
    d = docs.select(*COLUMNS, *_text_key(F.isnull("source"), F.col("source")))
    part = F.col("taken") - F.col("epochs") * F.col("size")
    taken = (mixing.mix(d, keep=("_t1", "_t2")).where("taken > 0").groupBy(*key)
             .agg(F.max("epochs").alias("epochs"), F.max("size").alias("size"),
                  F.count_if(part == F.col("size")).alias("whole"),
                  F.max(F.when(part < F.col("size"), part)).alias("part"))
             .select(*[F.col(c).alias(f"k{c}") for c in key], "epochs", "whole", "part"))
    d = d.join(taken, F.expr(" and ".join(f"{c} <=> k{c}" for c in key)))
    place = F.row_number().over(Window.partitionBy(*key).orderBy("lang"))
    d = (d.withColumn("place", place)
         .withColumn("times", F.col("epochs") + (F.col("place") <= F.col("whole")).cast("long")))
    first = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), 1,
                                 F.col("part").cast("int")), " ")
    texts = F.concat(F.array_repeat(F.col("text"), F.col("times").cast("int")),
                     F.when((F.col("place") == F.col("whole") + 1) & (F.col("part") > 0), F.array(first))
                     .otherwise(F.array().cast("array<string>")))
    return _documents(d.withColumn("text", F.explode(texts)))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of 2048 tokens."""
    small_batches(spark)
    return packed(docs)


STAGES = [
    ("language ID", language_id),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeated_strings),
    ("mixing", mix_sources),
    ("packing", pack),
]

# Fitted vectors, suffix sorting and token ids are beyond SQL; the stages are
# tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{i}")
    return docs
