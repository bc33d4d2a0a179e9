"""Small helpers shared by the query registry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DECIMALS = 6


def round_half_away(c, decimals: int = DECIMALS):
    """``x`` rounded to ``decimals`` as ``round(x * 10^d) / 10^d``, ties away
    from zero on the binary product. This is how DuckDB rounds doubles, so both
    engines produce the identical double even for exact decimal ties (a plain
    ``F.round`` rounds the decimal representation and can differ by one unit)."""
    p = F.lit(float(10 ** decimals))
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c * p, 0) / p


def round_doubles(df: DataFrame, decimals: int = DECIMALS, skip=()) -> DataFrame:
    """Round every double column (for engine-independent comparison)."""
    cols = []
    for f, t in df.dtypes:
        if t in ("double", "float") and f not in skip:
            cols.append(round_half_away(f, decimals).alias(f))
        else:
            cols.append(F.col(f))
    return df.select(*cols)
