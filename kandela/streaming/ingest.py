"""Landing of kline payload files into bronze, as a stream or a batch (R-1, R-2).

``readStream.text`` over a folder that a fetcher fills with payload files (one
JSON document per file, under ``symbol=<SYMBOL>/``, or of one symbol that is
given), parsed JVM-side like the batch path, then:

* only candles that were closed when their file was written are kept (the
  newest candle of a fetch may still be open; a later fetch has its final
  values);
* every micro-batch is merged into the (symbol, dt) partitions that it touches
  (``sources.sinks.land_candles``), the latest fetch winning. There is no
  watermark and nothing is late: candles of any age land, in whatever batches
  the files come, and a replayed batch changes nothing. So the table does not
  depend on ``max_files_per_trigger``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kandela.session import pin_utc
from kandela.sources.payload import parse_klines, read_payload_files, with_file_info
from kandela.sources.sinks import land_candles


def payload_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                   symbol: str | None = None) -> DataFrame:
    """Streaming frame of payload documents with ``symbol`` and file time."""
    r = spark.readStream.format("text").option("wholetext", "true")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return with_file_info(r.load(path), symbol)


def closed_klines(payloads: DataFrame) -> DataFrame:
    """Parsed candles that had closed when fetched (those without a close time are kept: landing
    puts them aside if they lack an open time too)."""
    k = parse_klines(payloads, keep=["symbol", "fetched_at"])
    return k.filter(F.coalesce(F.col("close_time") < F.col("fetched_at"), F.lit(True))).drop("ignore")


def land_bronze(spark: SparkSession, payload_dir: str, bronze_dir: str, checkpoint: str,
                available_now: bool = True, processing_time: str = "1 minute",
                max_files_per_trigger: int | None = None, symbol: str | None = None) -> StreamingQuery:
    """R-1/R-2: start the landing query (``availableNow`` drains the backlog and
    stops; otherwise a processing-time trigger, per-minute by default)."""
    pin_utc(spark)  # file times (zoned) are compared with UTC candle times
    bars = closed_klines(payload_stream(spark, payload_dir, max_files_per_trigger, symbol))
    w = (bars.writeStream.foreachBatch(lambda batch, _: land_candles(batch, bronze_dir))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()


def ingest_bronze(spark: SparkSession, payload_dir: str, bronze_dir: str, symbol: str | None = None) -> None:
    """The same as a batch: all payload files of a folder into bronze."""
    pin_utc(spark)
    land_candles(closed_klines(read_payload_files(spark, payload_dir, symbol=symbol)), bronze_dir)


def write_payload_files(payloads: DataFrame, out_dir: str) -> None:
    """Fixture helper: write payload documents (``symbol``, ``period``,
    ``value``) as one text file per document under ``symbol=<s>/``. Each
    document becomes its own file so ``wholetext`` reads it back whole."""
    (payloads.repartition("symbol", "period")
     .select("symbol", "period", "value")
     .write.mode("append").partitionBy("symbol", "period").text(out_dir))
