"""End to end through the job entry points: payload files -> bronze -> silver
-> model -> scored requests -> settled predictions -> daily monitor."""

import os

from conftest import SF_SMALL
from kandela import cli
from kandela.plans import fixtures as fx
from kandela.sources.payload import to_payloads
from kandela.streaming.ingest import write_payload_files


def test_jobs_end_to_end(spark, tmp_dir):
    p = lambda n: os.path.join(tmp_dir, n)
    b = fx.bronze(spark, SF_SMALL, fx.MINUTE, keyed=True)
    write_payload_files(to_payloads(b, ["symbol"], per="day"), p("payloads"))
    cli.main(["land", "--payloads", p("payloads"), "--bronze", p("bronze"),
              "--checkpoint", p("ck")], spark)
    assert spark.read.parquet(p("bronze")).count() == b.count()
    cli.main(["ingest", "--payloads", p("payloads"), "--bronze", p("bronze")], spark)  # the same fetch again
    assert spark.read.parquet(p("bronze")).count() == b.count()
    cli.main(["silver", "--bronze", p("bronze"), "--silver", p("silver"), "--block-rows", "64"], spark)
    n_silver = spark.read.parquet(p("silver")).count()
    assert n_silver == b.count() - 11 * b.select("symbol").distinct().count()
    cli.main(["train", "--silver", p("silver"), "--model", p("model")], spark)
    _, req = fx.requests(spark, SF_SMALL)
    req.write.parquet(p("requests"))
    cli.main(["score", "--bronze", p("bronze"), "--requests", p("requests"), "--model", p("model"),
              "--log", p("log")], spark)
    from kandela.plans.scoring import read_predictions
    log = read_predictions(spark, p("log"))
    # each request candle is already in bronze, so it is not newer than history: stale
    assert log.count() == 0
    for _ in range(2):  # the same batch twice: the re-run adds nothing
        cli.main(["score", "--bronze", p("bronze"), "--requests", p("requests"), "--model",
                  p("model"), "--log", p("log"), "--parity"], spark)
    assert read_predictions(spark, p("log")).count() == req.count()
    # the newest candles as a table: the same predictions without the history
    for _ in range(2):
        cli.main(["latest", "--bronze", p("bronze"), "--latest", p("latest")], spark)
    cli.main(["score", "--latest", p("latest"), "--requests", p("requests"), "--model", p("model"), "--log", p("log2"), "--parity"], spark)
    cols = ["request_id", "symbol", "timestamp", "predicted_price"]
    a, b = (read_predictions(spark, p(x)).select(*cols) for x in ("log", "log2"))
    assert a.count() == b.count() and a.exceptAll(b).count() == 0
    for _ in range(2):
        cli.main(["silver", "--bronze", p("bronze"), "--silver", p("followed"), "--follow"], spark)
    assert spark.read.parquet(p("followed")).count() == n_silver
    cli.main(["settle", "--log", p("log"), "--bronze", p("bronze"), "--out", p("settled")], spark)
    cli.main(["monitor", "--settled", p("settled"), "--out", p("monitor")], spark)
    m = spark.read.parquet(p("monitor")).collect()
    assert sum(r.n_predictions for r in m) == req.count()
