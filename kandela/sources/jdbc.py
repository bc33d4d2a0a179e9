"""JDBC read and write (S-3, K-4).

Writes keep the reference's batch size and writer parallelism as parameters.
Reads are partitioned on a numeric or time column (``numPartitions`` range
queries) instead of one whole-table query through a single task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
               mode: str = "overwrite", batchsize: int = 50_000, num_partitions: int = 10
               ) -> None:
    """K-4: batched, parallel JDBC write (each writer task is one connection)."""
    (df.write.mode(mode)
       .option("batchsize", str(batchsize))
       .option("numPartitions", str(num_partitions))
       .jdbc(url=url, table=table, properties=properties or {}))


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None,
              partition_column: str | None = None, lower=None, upper=None,
              num_partitions: int = 10) -> DataFrame:
    """S-3: partitioned range read when a column and bounds are given."""
    props = dict(properties or {})
    if partition_column is None:
        return spark.read.jdbc(url=url, table=table, properties=props)
    return (spark.read.format("jdbc")
            .option("url", url).option("dbtable", table)
            .option("partitionColumn", partition_column)
            .option("lowerBound", str(lower)).option("upperBound", str(upper))
            .option("numPartitions", str(num_partitions))
            .options(**props).load())
