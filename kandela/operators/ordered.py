"""Ordered-series windows that never route a series through one task.

Every window of the reference is ``Window.orderBy(open_time)`` with no partition
key, which plans ``Exchange SinglePartition``: the whole history goes through one
task. Here a series (optionally keyed, e.g. by symbol) is processed as:

1. **Dense index** ``_i`` (0-based, exact and deterministic): rank inside
   (keys, time bucket) with an ordinary partitioned ``row_number``, plus the
   number of rows in earlier buckets of the same key. The data is exchanged
   once on (keys, bucket). The per-bucket counts are partial-aggregated before
   their own small exchange; their running sum is a window over the count frame
   (one row per key and bucket), and the offsets join back on (keys, bucket).
   AQE broadcasts the offsets at run time when they are small; otherwise only
   the offsets are shuffled to meet the data's partitioning.
2. **Halo blocks** (``method="halo"``). ``block = _i div B``. A row is also
   copied into the next block when it lies in the last ``back`` positions of
   its block (history for lag / trailing frames) and into the previous block
   when it lies in the first ``fwd`` positions (future for lead). At most three
   copies, and only ``(back + fwd) / B`` of the rows are copies. The caller's
   window expressions run over ``partitionBy(keys, block).orderBy(_i)``; only
   rows whose own block is the window block are kept.
3. **Edge fix-up** (``method="edges"``, one exchange of the data): the windows
   run inside each (keys, bucket); only the ``back + fwd`` rows nearest each
   bucket edge need neighbours from other buckets, and those edge rows alone go
   through 1 and 2 (see :func:`_edge_window`).

Exact for offset functions (lag/lead) with offsets up to ``back``/``fwd`` and for
ROWS frames inside ``[-back, fwd]``. A hot key that holds a third of all rows is
spread over ``n / B`` blocks (halo) or over its buckets (edges) instead of one
task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kandela.session import scratch_path

DEFAULT_BLOCK_ROWS = 65_536
DEFAULT_BUCKET = "day"

_IDX = "_i"
_BKT = "_bkt"


def _as_list(x) -> list:
    if x is None:
        return []
    return [x] if isinstance(x, (str, Column)) else list(x)


def _bucket(t: Column, bucket_unit) -> Column:
    """Monotone coarse bucket of the order column: ``date_trunc`` for times,
    ``floor(t / n)`` when ``bucket_unit`` is a number."""
    if isinstance(bucket_unit, (int, float)):
        return F.floor(t / F.lit(bucket_unit))
    return F.date_trunc(bucket_unit, t)


def dense_index(df: DataFrame, order_by, keys: Sequence[str] = (),
                bucket_unit=DEFAULT_BUCKET, index_col: str = _IDX,
                total_col: str | None = None) -> DataFrame:
    """Add ``index_col``: 0-based position of each row in its series.

    ``order_by[0]`` is the time column; further entries break ties. Nulls sort
    first, as in an ascending window. ``total_col`` adds the series length
    (taken from the same small count frame, so it costs no extra pass).

    One exchange of the data: ``repartition(struct(keys), null flag, bucket)``.
    The ranking window and the join with the offsets use that partitioning; the
    per-bucket counts are partial-aggregated before their own (small) exchange. Join keys
    are plain non-null columns (keys wrapped in a struct, whose equality treats
    NULL fields as equal), so a sort-merge join does not re-shuffle the data.
    """
    order_by = _as_list(order_by)
    keys = list(keys)
    t0 = order_by[0]
    t0 = F.col(t0) if isinstance(t0, str) else t0
    b = _bucket(t0, bucket_unit)
    part = (["_sk"] if keys else []) + ["_bnull", _BKT]
    d0 = df.withColumns({
        **({"_sk": F.struct(*[F.col(k) for k in keys])} if keys else {}),
        "_bnull": b.isNull(),
        _BKT: F.coalesce(b, _min_like(b, bucket_unit)),
    })
    d = d0.repartition(*part)

    ranked = d.withColumn("_di_rn", F.row_number().over(Window.partitionBy(*part).orderBy(*order_by)))
    # counts from the un-shuffled frame: partial aggregation map-side, so only
    # one row per (map task, key, bucket) crosses the network
    counts = d0.groupBy(*part).agg(F.count(F.lit(1)).alias("_di_bn"))
    by_key = Window.partitionBy(*(["_sk"] if keys else []))
    before = by_key.orderBy(F.col("_bnull").desc(), F.col(_BKT)) \
        .rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select(
        *part,
        F.coalesce(F.sum("_di_bn").over(before), F.lit(0)).cast("long").alias("_di_off"),
        *([F.sum("_di_bn").over(by_key).cast("long").alias(total_col)] if total_col else []))
    out = ranked.join(offs, on=part, how="inner")
    keep = [c for c in df.columns] + ([total_col] if total_col else [])
    return out.select(*keep, (F.col("_di_off") + F.col("_di_rn") - F.lit(1)).alias(index_col))


def _min_like(b: Column, bucket_unit) -> Column:
    """A constant of the bucket's type, used in place of a NULL bucket (the
    ``_bnull`` flag keeps NULL-time rows apart and first)."""
    if isinstance(bucket_unit, (int, float)):
        return F.lit(0).cast("long")
    return F.lit("1970-01-01 00:00:00").cast("timestamp")


def time_index(df: DataFrame, order_by, keys: Sequence[str] = (), name: str = "rn",
               bucket_unit=DEFAULT_BUCKET, total_col: str | None = None) -> DataFrame:
    """``row_number() OVER (PARTITION BY keys ORDER BY order_by)`` without the
    single-partition exchange (1-based, like ``row_number``)."""
    out = dense_index(df, order_by, keys, bucket_unit, index_col="_ti", total_col=total_col)
    return out.withColumn(name, F.col("_ti") + F.lit(1)).drop("_ti")


def range_index(df: DataFrame, order_by, keys: Sequence[str] = (), name: str = "rn",
                total_col: str | None = None) -> DataFrame:
    """The same numbers as :func:`time_index` without time buckets, for series whose rows may pile up anywhere:
    a third of them at one time, or without one, in one series or over all.

    Rows are dealt to ranges of (keys, ``order_by``, a hash of the row, a number), whose bounds Spark samples,
    so rows that are equal in everything else are split as well. In a range a row's place is its place in
    the sorted partition; that and the range are kept in a table in the shared folder. A range's first number
    comes from the counts of the ranges before (one row for each range), a series' first number is the least
    of its rows. One exchange and one sort of the data, and no task holds more than a range."""
    order_by, keys = _as_list(order_by), list(keys)
    plain = [f.name for f in df.schema.fields if f.name not in (*keys, *order_by) and not isinstance(f.dataType, T.MapType)]
    order = [F.col(c).asc_nulls_first() for c in [*keys, *order_by]] + [F.col("_tie"), F.col("_row")]
    tie = F.xxhash64(*plain) if plain else F.lit(0).cast("long")
    d = df.withColumn("_tie", tie).withColumn("_row", F.monotonically_increasing_id())
    d = d.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()).drop("_tie", "_row")
    path = scratch_path(df.sparkSession, "ranges")
    d.write.parquet(path)
    d = df.sparkSession.read.schema(d.schema).parquet(path)
    # the number of a partition is above its rows' numbers, which have 33 bits
    d = d.withColumn("_range", F.shiftright("_at", 33)).withColumn("_place", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).drop("_at")
    counts = d.groupBy("_range").agg((F.max("_place") + 1).alias("_n"))
    all_ = Window.partitionBy(F.lit(0))  # of one row for each range
    before = counts.select("_range", (F.sum("_n").over(all_.orderBy("_range")) - F.col("_n")).alias("_before"), F.sum("_n").over(all_).alias("_all"))
    d = d.join(before, "_range").withColumn("_i", F.col("_before") + F.col("_place"))
    if not keys:
        out = d.withColumn("_first", F.lit(0).cast("long")).withColumn("_of", F.col("_all"))
    else:
        first = d.groupBy(F.struct(*keys).alias("_sk")).agg(F.min("_i").alias("_first"), F.count("*").alias("_of"))
        out = d.withColumn("_sk", F.struct(*keys)).join(first, "_sk")
    total = [F.col("_of").alias(total_col)] if total_col else []
    return out.select(*df.columns, *total, (F.col("_i") - F.col("_first") + 1).alias(name))


def ordered_window(df: DataFrame, columns: Callable[[WindowSpec], dict[str, Column]],
                   order_by, keys: Sequence[str] = (), back: int = 0, fwd: int = 0,
                   method: str = "halo", block_rows: int = DEFAULT_BLOCK_ROWS,
                   bucket_unit=DEFAULT_BUCKET) -> DataFrame:
    """Add the window columns built by ``columns(w)``.

    ``w`` is a window ordered along each series; ``columns`` may use offset
    functions and ROWS frames reaching at most ``back`` rows behind and ``fwd``
    rows ahead (e.g. ``F.lag(c, 1).over(w)``, ``F.avg(c).over(w.rowsBetween(-9, 0))``).
    ``method="global"`` is the plain partitioned window (one task per key); use
    it only when every key is known to be small. ``method="edges"`` (see
    :func:`_edge_window`) shuffles the data once instead of twice; it needs time
    buckets that hold many more than ``back + fwd`` rows (a day of minute
    candles, a month of hourly ones).
    """
    order_by = _as_list(order_by)
    keys = list(keys)
    if method == "global":
        w = Window.partitionBy(*keys).orderBy(*order_by)
        return df.withColumns(columns(w))
    if method == "edges":
        return _edge_window(df, columns, order_by, keys, back, fwd, block_rows, bucket_unit)
    if method != "halo":
        raise ValueError(f"method must be 'halo', 'edges' or 'global', not {method!r}")
    B = int(block_rows)
    if B < max(back, fwd, 1):
        raise ValueError(f"block_rows={B} must be >= max(back={back}, fwd={fwd})")

    idx = dense_index(df, order_by, keys, bucket_unit)
    if keys:
        idx = idx.withColumn("_sk", F.struct(*[F.col(k) for k in keys]))
    out = _halo_blocks(idx, columns, ["_sk"] if keys else [], back, fwd, B)
    return out.select(*df.columns, *[c for c in out.columns if c not in idx.columns])


def _halo_blocks(idx: DataFrame, columns, sk: list, back: int, fwd: int, B: int) -> DataFrame:
    """Windows over halo blocks of a frame carrying the dense index ``_i``.

    Each row goes to its block ``_i div B``, and also to the next block when it
    is among its block's last ``back`` rows, and to the previous block when it
    is among the first ``fwd``. The windows run per (sk, block) ordered by
    ``_i``; only rows in their own block are returned (with ``idx``'s columns
    plus the window columns).
    """
    i = F.col(_IDX)
    own = F.expr(f"{_IDX} div {B}")
    pos = F.pmod(i, F.lit(B))
    copies = F.array(
        own,
        F.when(pos >= F.lit(B - back), own + 1) if back > 0 else F.lit(None).cast("long"),
        F.when((pos < F.lit(fwd)) & (own > 0), own - 1) if fwd > 0 else F.lit(None).cast("long"))
    ex = idx.select(*idx.columns, own.alias("_own"),
                    F.explode(F.array_compact(copies)).alias("_blk"))
    w = Window.partitionBy(*sk, "_blk").orderBy(_IDX)
    out = ex.withColumns(columns(w)).filter(F.col("_blk") == F.col("_own"))
    return out.drop("_blk", "_own")


def _edge_window(df: DataFrame, columns, order_by: list, keys: list, back: int, fwd: int,
                 block_rows: int, bucket_unit) -> DataFrame:
    """Bucket-local windows with an edge fix-up: one exchange of the data.

    1. The windows run inside each (keys, time bucket) group after one exchange.
       A row whose whole frame ``[-back, +fwd]`` lies inside its bucket
       (``back < rn <= cnt - fwd``) already has its exact value.
    2. The first and last ``K = back + fwd`` rows of every bucket (all of them
       if the bucket holds at most 2K) form the edge series. For a row near a
       bucket edge, every row of its frame is in the edge series and contiguous
       there. The edge series is numbered without another pass over the data:
       bucket b contributes ``min(cnt_b, 2K)`` edge rows, and the bucket counts
       come from a partial-aggregated count of the input (one row per map task,
       key and bucket). The offsets join the edge rows on exactly the data's
       partitioning, so the data is not shuffled again.
    3. The edge rows go through halo blocks of ``block_rows`` (only edge rows
       are copied and exchanged) for their exact values; they are unioned
       with the inner rows of 1. No join of the data.
    """
    K = back + fwd
    B = int(block_rows)
    t0 = order_by[0]
    t0 = F.col(t0) if isinstance(t0, str) else t0
    b = _bucket(t0, bucket_unit)
    sk = ["_sk"] if keys else []
    part = sk + ["_bnull", _BKT]
    d = df.withColumns({
        **({"_sk": F.struct(*[F.col(k) for k in keys])} if keys else {}),
        "_bnull": b.isNull(),
        _BKT: F.coalesce(b, _min_like(b, bucket_unit)),
    })
    # edge-series offsets per bucket, from a partial-aggregated count
    counts = d.groupBy(*part).agg(F.count(F.lit(1)).alias("_ec"))
    before = Window.partitionBy(*sk).orderBy(F.col("_bnull").desc(), F.col(_BKT)) \
        .rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select(*part, F.coalesce(F.sum(F.least(F.col("_ec"), F.lit(2 * K))).over(before),
                                           F.lit(0)).cast("long").alias("_eoff"))

    local = Window.partitionBy(*part).orderBy(*order_by)
    feats = columns(local)
    names = list(feats)
    d = d.withColumns({**feats, "_lrn": F.row_number().over(local),
                       "_lcnt": F.count(F.lit(1)).over(Window.partitionBy(*part))})
    rn, cnt = F.col("_lrn"), F.col("_lcnt")
    inner = (rn > F.lit(back)) & (rn <= cnt - F.lit(fwd))
    base = [c for c in df.columns if c not in names]
    main = d.filter(inner).select(*base, *names)

    edge = d.filter((rn <= F.lit(K)) | (rn > cnt - F.lit(K))).select(*base, *part, "_lrn", "_lcnt")
    pos = F.when(rn <= F.lit(K), rn - 1).otherwise(
        F.lit(K) + rn - F.greatest(F.lit(K + 1), cnt - F.lit(K - 1)))
    e = (edge.join(offs, on=part, how="inner")
             .select(*base, *sk, "_lrn", "_lcnt", (F.col("_eoff") + pos).alias(_IDX)))
    fixed = _halo_blocks(e, columns, sk, back, fwd, B).filter(~inner)
    return main.unionByName(fixed.select(*base, *names))
