"""Streaming OHLCV bars (A8 on a stream).

Two forms share one sink format.  A backfill (no watermark) turns every
micro-batch into partial bars that carry the order keys of their open and
close; ``latest_bars`` merges the partial bars of a bar, so the result is the
batch result whatever the file order and however late a tick comes.  With a
``watermark`` the engine keeps the bars as state and drops ticks older than it
(live use); how many it dropped is returned.  Both append to a parquet table
under the shared checkpoint root."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ripplet.functions.expr import micros_to_ntz, ntz_to_micros
from ripplet.session import checkpoint_root
from ripplet.sources.bars import event_order_key
from ripplet.sources.tables import stream_table


def _ohlcv() -> list:
    return [F.min("_key").alias("first_key"), F.max("_key").alias("last_key"),
            F.min_by("value", "_key").alias("open"), F.max("value").alias("high"),
            F.min("value").alias("low"), F.max_by("value", "_key").alias("close"),
            F.count(F.lit(1)).cast("double").alias("volume")]


def partial_bars(events: DataFrame, bar: str = "hour") -> DataFrame:
    """Bars of one micro-batch with the order keys of their first and last tick."""
    return (events.withColumn("_key", event_order_key())
                  .groupBy(F.col("event_type").alias("symbol"), F.date_trunc(bar, "ts").alias("date")).agg(*_ohlcv()))


def bars_stream(events: DataFrame, bar: str = "1 hour", watermark: str = "2 hours") -> DataFrame:
    """Bars as event-time state; ticks older than the watermark are dropped by the engine."""
    micros = ntz_to_micros(F.col("ts"))
    # Watermarks need TIMESTAMP (LTZ): build it from epoch micros (zone-free),
    # and map window starts back to TIMESTAMP_NTZ the same way.
    ev = events.withColumns({"_et": F.timestamp_micros(micros), "_key": event_order_key()})
    back = micros_to_ntz(F.unix_micros(F.col("w.start")))
    bars = (ev.withWatermark("_et", watermark)
              .groupBy(F.col("event_type").alias("symbol"), F.window("_et", bar).alias("w")).agg(*_ohlcv()))
    return bars.select("symbol", back.alias("date"), "first_key", "last_key", "open", "high", "low", "close", "volume")


def run_bars_stream(spark: SparkSession, events_path: str, schema, bar: str = "hour",
                    watermark: str | None = None, max_files_per_trigger: int = 1) -> tuple[str, int]:
    """Process every available file of the table at ``events_path`` (a file, or a directory of part files) with
    availableNow; returns (sink path, ticks dropped by the watermark: 0 without one)."""
    root = os.path.join(checkpoint_root(spark), "streams", f"bars-{uuid.uuid4().hex[:12]}")
    sink, ckpt = os.path.join(root, "sink"), os.path.join(root, "checkpoint")
    src = stream_table(spark, events_path, schema, max_files_per_trigger)

    def write(batch: DataFrame, batch_id: int) -> None:
        made = batch if watermark else partial_bars(batch, bar)
        # A retried batch writes its own folder again, so it is never counted twice.
        made.write.mode("overwrite").parquet(os.path.join(sink, f"batch_id={batch_id}"))

    stream = bars_stream(src, f"1 {bar}", watermark).writeStream.outputMode("update") if watermark else src.writeStream
    q = stream.foreachBatch(write).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    q.awaitTermination()
    dropped = sum(op.get("numRowsDroppedByWatermark", 0) for p in q.recentProgress for op in p["stateOperators"])
    return sink, int(dropped)


def latest_bars(spark: SparkSession, sink: str, watermark: str | None = None) -> DataFrame:
    """The bars of a sink: partial bars merged, or with a watermark the newest version of each."""
    df = spark.read.parquet(sink)
    if watermark:
        v = F.struct("open", "high", "low", "close", "volume")
        return (df.groupBy("symbol", "date").agg(F.max_by(v, "batch_id").alias("v"))
                  .select("symbol", "date", "v.open", "v.high", "v.low", "v.close", "v.volume"))
    return df.groupBy("symbol", "date").agg(
        F.min_by("open", "first_key").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"),
        F.max_by("close", "last_key").alias("close"), F.sum("volume").alias("volume"))
