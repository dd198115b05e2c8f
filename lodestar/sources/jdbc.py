"""S5 (optional): an external relational warehouse over JDBC.

Needs a JDBC driver jar on the classpath and a reachable server, so it is not
exercised by the tests. Reads are split into parallel range queries on a
numeric column; writes go out in batches from every partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, url: str, table: str, properties: dict,
               partition_column: str | None = None, lower: int | None = None,
               upper: int | None = None, num_partitions: int = 1) -> DataFrame:
    if partition_column:
        return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower,
                               upperBound=upper, numPartitions=num_partitions,
                               properties=properties)
    return spark.read.jdbc(url, table, properties=properties)


def write_table(df: DataFrame, url: str, table: str, properties: dict,
                mode: str = "append", batch_size: int = 10000) -> None:
    props = dict(properties)
    props.setdefault("batchsize", str(batch_size))
    df.write.jdbc(url, table, mode=mode, properties=props)
