"""Scans of the driver tables and of candle tables (S-2).

Reads are lazy; Catalyst prunes columns and pushes filters into the Parquet scan.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DateType, StringType, StructField, StructType

from kandela.schema import BRONZE


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def table(spark: SparkSession, sf_dir: str, name: str,
          schema: StructType | None = None) -> DataFrame:
    """One driver table (``events``, ``customer``, ...)."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(table_path(sf_dir, name))


def load_bars(spark: SparkSession, path: str, schema: StructType | None = BRONZE,
              keys=()) -> DataFrame:
    """Scan a candle table with a fixed schema: key columns are strings whatever
    they look like (a ticker ``007`` stays ``007``, also as a partition folder),
    ``dt`` is a date. Partition pruning applies to filters on ``symbol``/``dt``.
    The stored columns are looked up once, to refuse a table that lacks some.
    """
    if schema is None:
        return spark.read.parquet(path)
    stored = spark.read.parquet(path).schema
    fields = [StructField(k, DateType() if k == "dt" else StringType()) for k in keys] + list(schema.fields)
    missing = [f.name for f in fields if f.name not in stored.names]
    if missing:
        raise ValueError(f"candle table at {path} lacks columns {missing}")
    # files of another numeric type are cast by name; partition folders are read with the given type
    typed = StructType([f if f.name in keys else StructField(f.name, stored[f.name].dataType) for f in fields])
    df = spark.read.schema(typed).parquet(path)
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) if typed[f.name].dataType != f.dataType
                       else df[f.name] for f in fields])
