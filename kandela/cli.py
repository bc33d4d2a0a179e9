"""Job entry points (``spark-submit -m``-style): ``python -m kandela.cli <job> ...``.

Each job is one lazy plan between tables in shared storage:

* ``land``    payload files -> bronze (Structured Streaming, ``availableNow`` or every minute)
* ``ingest``  payload files -> bronze, as one batch (same merge)
* ``silver``  bronze -> silver (features, label, null drop; partitioned by symbol and day); with ``--follow`` only
  what landed since the last run
* ``latest``  bronze -> table of each symbol's newest candles, following what landed
* ``train``   silver -> model (+ metrics printed as JSON)
* ``score``   requests + bronze history + model -> prediction log (rows already logged are skipped)
* ``settle``  prediction log + bronze -> settled predictions
* ``monitor`` settled predictions -> daily RMSE/MAE per model version
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from kandela.session import get_session, pin_utc

KEYS = ["symbol"]


def land(spark: SparkSession, a) -> None:
    from kandela.streaming.ingest import land_bronze
    q = land_bronze(spark, a.payloads, a.bronze, a.checkpoint,
                    available_now=not a.continuous, max_files_per_trigger=a.max_files, symbol=a.symbol)
    q.awaitTermination()


def ingest(spark: SparkSession, a) -> None:
    from kandela.streaming.ingest import ingest_bronze
    ingest_bronze(spark, a.payloads, a.bronze, symbol=a.symbol)


def silver(spark: SparkSession, a) -> None:
    from kandela.plans.silver import build_silver, follow_landing, write_silver
    from kandela.sources.tables import load_bars
    if a.follow:
        follow_landing(spark, a.bronze, a.silver, method=a.method, bucket_unit=a.bucket, block_rows=a.block_rows)
        return
    s = build_silver(load_bars(spark, a.bronze, keys=KEYS), KEYS, method=a.method,
                     bucket_unit=a.bucket, block_rows=a.block_rows)
    write_silver(s, a.silver, KEYS)


def latest(spark: SparkSession, a) -> None:
    from kandela.plans.latest import follow_landing
    follow_landing(spark, a.bronze, a.latest)


def train(spark: SparkSession, a) -> None:
    from kandela.plans.training import run_training
    from kandela.plans.silver import SILVER
    from kandela.sources.tables import load_bars
    s = load_bars(spark, a.silver, SILVER, KEYS)
    res = run_training(s, KEYS, a.ratio, a.embargo, refit=a.refit, model_path=a.model)
    print(json.dumps(res.metrics.first().asDict()))


def score(spark: SparkSession, a) -> None:
    from kandela.plans.model import load_model
    from kandela.plans.scoring import append_predictions, requests_frame, score_candidates
    from kandela.sources.tables import load_bars
    if a.inline:
        requests = requests_frame(spark, json.loads(a.inline))
    else:
        requests = spark.read.parquet(a.requests)
    if a.latest:
        from kandela.plans.latest import read_latest
        history = read_latest(spark, a.latest)
    else:
        history = load_bars(spark, a.bronze, keys=[*KEYS, "dt"])
    pred = score_candidates(history, requests, load_model(a.model), parity=a.parity)
    append_predictions(pred, a.log)


def settle(spark: SparkSession, a) -> None:
    from kandela.plans.scoring import read_predictions
    from kandela.plans.settlement import settle_log
    from kandela.sources.tables import load_bars
    settle_log(read_predictions(spark, a.log), load_bars(spark, a.bronze, keys=[*KEYS, "dt"]), a.out)


def monitor(spark: SparkSession, a) -> None:
    from kandela.plans.settlement import monitor_daily
    monitor_daily(spark.read.parquet(a.settled)).write.mode("overwrite").parquet(a.out)


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="kandela")
    sub = ap.add_subparsers(dest="job", required=True)
    p = sub.add_parser("land")
    p.add_argument("--payloads", required=True)
    p.add_argument("--bronze", required=True)
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--max-files", type=int, default=None)
    p.add_argument("--symbol", help="of payloads that lie in no symbol=... folder")
    p.add_argument("--continuous", action="store_true", help="per-minute trigger instead of availableNow")
    p = sub.add_parser("ingest")
    p.add_argument("--payloads", required=True)
    p.add_argument("--symbol", help="of payloads that lie in no symbol=... folder")
    p.add_argument("--bronze", required=True)
    p = sub.add_parser("silver")
    p.add_argument("--bronze", required=True)
    p.add_argument("--silver", required=True)
    p.add_argument("--block-rows", type=int, default=65_536)
    p.add_argument("--method", default="edges", choices=["edges", "halo", "global"],
                   help="edges: one exchange, buckets must hold >> 19 candles; halo: two")
    p.add_argument("--bucket", default="day", help="time bucket (day for minute candles)")
    p.add_argument("--follow", action="store_true", help="rebuild only what landed since the last run changes")
    p = sub.add_parser("latest")
    p.add_argument("--bronze", required=True)
    p.add_argument("--latest", required=True)
    p = sub.add_parser("train")
    p.add_argument("--silver", required=True)
    p.add_argument("--model", required=True)
    p.add_argument("--ratio", type=float, default=0.8)
    p.add_argument("--embargo", type=int, default=0)
    p.add_argument("--refit", action="store_true", help="recompute features on silver (DAG rule)")
    p = sub.add_parser("score")
    history = p.add_mutually_exclusive_group(required=True)
    history.add_argument("--bronze")
    history.add_argument("--latest", help="table of the job latest, instead of the whole history")
    p = p.add_mutually_exclusive_group(required=True)
    p.add_argument("--requests", help="table of requests")
    p.add_argument("--inline", help="JSON list of requests")
    p = sub.choices["score"]
    p.add_argument("--model", required=True)
    p.add_argument("--log", required=True)
    p.add_argument("--parity", action="store_true")
    p = sub.add_parser("settle")
    p.add_argument("--log", required=True)
    p.add_argument("--bronze", required=True)
    p.add_argument("--out", required=True)
    p = sub.add_parser("monitor")
    p.add_argument("--settled", required=True)
    p.add_argument("--out", required=True)
    return ap


JOBS = {"land": land, "ingest": ingest, "silver": silver, "latest": latest, "train": train, "score": score, "settle": settle,
        "monitor": monitor}


def main(argv=None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(argv)
    spark = spark or get_session(f"kandela-{a.job}")
    pin_utc(spark)
    JOBS[a.job](spark, a)


if __name__ == "__main__":
    main()
