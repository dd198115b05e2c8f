"""Reading inputs and holding intermediate tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.session import checkpoint_root, scratch_path

# A word: a run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """The named input table, cut to ``cols`` so other columns cannot clash."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


def small_batches(spark: SparkSession, most: str = "4m") -> None:
    """Hand texts to Python workers in batches of bounded bytes, not only of a
    bounded number of rows."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", most)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the session's shared folder."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    For wide intermediates: columnar and compressed, and a lost executor
    re-reads it instead of recomputing the job before it.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def uniform(*cols: Column) -> Column:
    """A reproducible number in [0, 1) from the columns (52 bits of a hash)."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 12) / F.lit(float(1 << 52))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
