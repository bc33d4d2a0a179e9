"""Chronological train/test split (F-1, M-4).

The reference counts on the driver and numbers rows with a global
``row_number``. Here the series length comes from the dense index's small count
frame and the index itself is exact without a single-partition exchange; the
cut is ``floor(n * ratio)`` like ``int(total * ratio)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kandela.operators.ordered import DEFAULT_BUCKET, range_index, time_index


def indexed(df: DataFrame, time_col: str = "open_time", keys: Sequence[str] = (),
            ratio: float = 0.8, bucket_unit: str = DEFAULT_BUCKET, ties: Sequence[str] = (),
            ranges: bool = False) -> DataFrame:
    """Add ``rn`` (1-based time rank per key; equal times by ``ties``) and ``_cut``
    (last train rank). ``ranges``: by sampled ranges instead of time buckets, where a bucket may
    hold very many rows (all series together, or rows without a time)."""
    if ranges:
        out = range_index(df, [time_col, *ties], keys, name="rn", total_col="_n")
    else:
        out = time_index(df, [time_col, *ties], keys, name="rn", bucket_unit=bucket_unit, total_col="_n")
    return out.withColumn("_cut", F.floor(F.col("_n") * F.lit(float(ratio))).cast("long")).drop("_n")


def split_indexed(idx: DataFrame, embargo: int = 0, keep_index: bool = False,
                  drop_cols=()) -> tuple[DataFrame, DataFrame]:
    """Train/test filters on a frame that already carries ``rn`` and ``_cut``
    (from :func:`indexed`), e.g. after it was checkpointed: no further shuffle."""
    train = idx.filter(F.col("rn") <= F.col("_cut"))
    test = idx.filter(F.col("rn") > F.col("_cut") + F.lit(int(embargo)))
    drop = ["_cut"] + ([] if keep_index else ["rn"]) + list(drop_cols)
    return train.drop(*drop), test.drop(*drop)


def pooled_split(df: DataFrame, ratio: float = 0.8, time_col: str = "open_time",
                 series: Sequence[str] = ("symbol",), embargo: int = 0, keep_index: bool = False
                 ) -> tuple[DataFrame, DataFrame]:
    """One cut through all series together, for a model that is fitted on all of
    them: the earliest ``floor(n*ratio)`` of all rows train. So no training row
    is newer than any test row, however unevenly the series end. Ranked by sampled
    ranges, as a day of all series may be a large part of the rows."""
    return split_indexed(indexed(df, time_col, (), ratio, ties=series, ranges=True), embargo, keep_index)


def chronological_split(df: DataFrame, ratio: float = 0.8, time_col: str = "open_time",
                        keys: Sequence[str] = (), embargo: int = 0, keep_index: bool = False,
                        drop_time: bool = False, bucket_unit: str = DEFAULT_BUCKET
                        ) -> tuple[DataFrame, DataFrame]:
    """Earliest ``floor(n*ratio)`` rows of each series train, the rest test.

    ``embargo=k`` leaves out the first k test rows, whose features overlap the
    last training labels (G8); 0 is the reference's behaviour.
    """
    idx = indexed(df, time_col, keys, ratio, bucket_unit)
    return split_indexed(idx, embargo, keep_index, [time_col] if drop_time else [])
