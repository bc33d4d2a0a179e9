"""Relations between the prediction log and users (J-1 ... J-3, S-7).

The user dimension is small relative to the log, but its size is not assumed:
Catalyst broadcasts it only when its statistics are under
``spark.sql.autoBroadcastJoinThreshold`` (AQE re-checks the real size at run
time); otherwise the join stays a shuffle join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def user_predictions(predictions: DataFrame, users: DataFrame,
                     user_cols: Sequence[str] = ("username",)) -> DataFrame:
    """J-1: predictions with their user's attributes (inner join on user_id)."""
    u = users.select("user_id", *user_cols)
    return predictions.join(u, on="user_id", how="inner")


def orphan_predictions(predictions: DataFrame, users: DataFrame) -> DataFrame:
    """J-2: predictions whose user no longer exists (what an ON DELETE CASCADE
    would remove). Anti join; a NULL user_id counts as orphan."""
    return predictions.join(users.select("user_id"), on="user_id", how="left_anti")


def cascade_delete(predictions: DataFrame, users: DataFrame) -> DataFrame:
    """J-2: the prediction log after the cascade: rows whose user remains."""
    return predictions.join(users.select("user_id"), on="user_id", how="left_semi")


def unique_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """J-3: for each unique key, the values that occur more than once:
    (key_name, key_value, occurrences). Each key is a partial-aggregated
    group-by; the key results are unioned."""
    parts = []
    for k in keys:
        parts.append(df.groupBy(F.col(k).cast("string").alias("key_value"))
                     .agg(F.count(F.lit(1)).alias("occurrences"))
                     .filter(F.col("occurrences") > 1)
                     .select(F.lit(k).alias("key_name"), "key_value", "occurrences"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def lookup_first(df: DataFrame, column: str, value) -> DataFrame:
    """S-7: first row with ``column == value`` (filter pushed to the scan)."""
    return df.filter(F.col(column) == F.lit(value)).limit(1)
