"""Session helpers.

The library never creates a cluster-wide configuration on its own: ``get_session``
is for scripts and tests; jobs running under ``spark-submit`` pass their own
session in. ``checkpoint_dir`` reads ``spark.checkpoint.dir`` from the session and
only invents a folder when none is set (local tests).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every kandela job relies on. Time zone is pinned to UTC because the
# payload epochs, request times and prediction horizons are all UTC (G11).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(app: str = "kandela", master: str | None = None,
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def pin_utc(spark: SparkSession) -> None:
    """Session time zone must be UTC for epoch <-> timestamp conversions."""
    if spark.conf.get("spark.sql.session.timeZone", "UTC") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and stage tables.

    Uses ``spark.checkpoint.dir`` when the cluster names one; otherwise (local
    tests only) creates a fresh folder under the system temp dir and registers
    it, so ``DataFrame.checkpoint()`` works.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: a cluster job needs a shared "
                               "folder for checkpoints and stage tables")
        d = tempfile.mkdtemp(prefix="kandela-ckpt-")  # local mode only (tests)
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # noqa: BLE001 - core conf may be read-only; setCheckpointDir suffices
            pass
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for a stage table (a URI
    of the same file system; made by whoever writes there)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
