"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import os
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from kandela.session import checkpoint_dir

#: Words are runs of anything but blank, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"


#: The folder that holds the package.
ROOT = str(Path(__file__).resolve().parents[2])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the corpus folder. Python workers of a session that was started elsewhere are told
    where the package is; a cluster gets it with ``--py-files``."""
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if ROOT not in paths.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [paths, ROOT]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def set_aside(df: DataFrame, *used: str) -> tuple[DataFrame, list[Column]]:
    """``df`` with every column but the ``used`` ones renamed by its place (of equal names the first is
    meant), so that none can clash with an operator's own; and the columns that restore all names."""
    names, seen = [], set()
    for i, c in enumerate(df.columns):
        names.append(c if c in used and c not in seen else f"_{i}")
        seen.add(c)
    return df.toDF(*names), [F.col(n).alias(c) for n, c in zip(names, df.columns, strict=True)]


def narrow(df: DataFrame, *used: str) -> DataFrame:
    """The ``used`` columns alone, whatever else is there."""
    return set_aside(df, *used)[0].select(*used)


def stage(df: DataFrame, name: str, batch: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder of ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage with files that survive the loss of an executor, and lets several plans
    read the rows without making them again. ``batch``: most bytes that go to a Python worker at
    a time, for rows that are large themselves."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_BATCH)
    if batch:
        bounded_batches(spark, batch)
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_BATCH, before)
    return spark.read.schema(df.schema).parquet(path)


_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession, most: int = 4 << 20) -> None:
    """From now on Python workers of this session get at most ``most`` bytes at a time (a session that has a
    smaller bound keeps it): what they hold is a multiple of that, and so is what Spark holds for them."""
    now = int(spark.conf.get(_BATCH).rstrip("b")) if spark.conf.get(_BATCH).rstrip("b").isdigit() else None
    if now is None or now > most:
        spark.conf.set(_BATCH, f"{most}b")


#: Copies of a row that one task makes from it.
CHUNK = 100_000


def repeated(rows: DataFrame, times: str, number: str) -> DataFrame:
    """Each row as often as its column ``times`` says (none for 0), numbered from 0 in ``number``. Of a row that
    is repeated very often, stretches of ``CHUNK`` copies are made in different tasks."""
    few = rows.where(F.col(times).between(1, CHUNK)).withColumn(number, F.explode(F.sequence(F.lit(0).cast("long"), F.col(times).cast("long") - 1)))
    many = rows.where(F.col(times) > CHUNK).withColumn("_first", F.explode(F.expr(f"sequence(0L, ({times} - 1L) div {CHUNK})"))).repartition("_first")
    most = F.least(F.col(times).cast("long"), (F.col("_first") + 1) * CHUNK) - 1
    return few.unionByName(many.withColumn(number, F.explode(F.sequence(F.col("_first") * CHUNK, most))).drop("_first"))


def row_hash(df: DataFrame) -> Column:
    """A hash of all columns of a row, whatever their types."""
    return F.xxhash64(*(F.sort_array(F.map_entries(f.name)) if isinstance(f.dataType, MapType) else F.col(f.name) for f in df.schema.fields))


def uniform(*keys: Column | int) -> Column:
    """A number in [0, 1) that depends on the keys alone, so reruns agree."""
    h = F.xxhash64(*(F.lit(k) if isinstance(k, int) else k for k in keys))
    return F.shiftrightunsigned(h, 11) / F.lit(float(1 << 53))


def nullable_key(c: Column) -> Column:
    """A key that is never null and tells null from every text."""
    return F.when(c.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), c.cast("string")))
