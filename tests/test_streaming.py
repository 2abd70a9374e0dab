"""Streaming operators equal their batch twins on the same rows."""
import datetime as dt
import os
import tempfile

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from ripplet.operators import forecast as FC
from ripplet.operators.naive_bayes import explode_vectors, fit_gnb, gnb_from_stats
from ripplet.plans.panel import daily_panel
from ripplet.sources.tables import read_table
from ripplet.sources.bars import hourly_bars_from_events
from ripplet.streaming.bars import latest_bars, run_bars_stream
from ripplet.streaming.incremental import ewma_state_fn, ewma_stream, merged_stats, run_incremental_gnb

SF = "/root/testdata/sf0.001"


def split_table(df, path, n, key):
    """A directory table of ``n`` files whose rows are dealt out by a hash, so no file is time-ordered."""
    df.withColumn("_p", F.pmod(F.xxhash64(key), F.lit(n))).repartition(n, "_p").drop("_p").write.parquet(path)
    return path


def test_incremental_gnb_equals_full_fit(spark):
    emb = read_table(spark, SF, "embeddings")
    path = os.path.join(tempfile.mkdtemp(prefix="ripplet-emb-"), "embeddings.parquet")
    split_table(emb, path, 3, "vec_id")
    sink = run_incremental_gnb(spark, path, emb.schema)
    assert spark.read.parquet(sink).select("batch_id").distinct().count() > 1
    inc = gnb_from_stats(merged_stats(spark, sink)).orderBy("class", "j").collect()
    full = fit_gnb(explode_vectors(emb, "vec_id", "embedding", extra=("label",))).orderBy("class", "j").collect()
    assert len(inc) == len(full)
    for a, b in zip(inc, full):
        assert (a["class"], a["j"]) == (b["class"], b["j"])
        np.testing.assert_allclose([a.mu, a.log_prior], [b.mu, b.log_prior], rtol=1e-9)
        np.testing.assert_allclose(a.var, b.var, rtol=1e-6)


def test_ewma_state_stream_equals_batch_scan(spark):
    panel = daily_panel(spark, SF).select("symbol", "date", "log_return").cache()
    d = tempfile.mkdtemp(prefix="ripplet-ret-")
    dates = sorted(r.date for r in panel.select("date").distinct().collect())
    cuts = [dates[0], dates[len(dates) // 3], dates[2 * len(dates) // 3], dates[-1]]
    for i in range(3):
        lo, hi = cuts[i], cuts[i + 1]
        part = panel.where((F.col("date") >= lo) & ((F.col("date") < hi) if i < 2 else F.lit(True)))
        part.coalesce(1).write.parquet(os.path.join(d, f"b{i}"))
    q = (ewma_stream(spark.readStream.schema(panel.schema).option("maxFilesPerTrigger", 1)
                     .option("recursiveFileLookup", "true").parquet(d))
         .writeStream.format("memory").queryName("ewma_state_test").outputMode("append")
         .option("checkpointLocation", tempfile.mkdtemp(prefix="ripplet-ck-")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.table("ewma_state_test")
    ref = FC.ewma(daily_panel(spark, SF)).select("symbol", "date", (F.col("y_pred") ** 2).alias("ref"))
    j = got.join(ref, ["symbol", "date"]).select(F.max(F.abs(F.col("sigma2") - F.col("ref")) /
                                                       F.col("ref")).alias("err"), F.count(F.lit(1)).alias("n"))
    row = j.collect()[0]
    assert row.n == panel.count()
    assert row.err < 1e-9


def same_bars(a, b):
    def rows(df):
        return sorted((r.symbol, r.date, r.open, r.high, r.low, r.close, r.volume) for r in df.collect())
    return rows(a) == rows(b)


def test_stream_bars_equal_batch_for_any_file_layout(spark):
    events = read_table(spark, SF, "events")
    want = hourly_bars_from_events(spark, SF)
    sink, dropped = run_bars_stream(spark, os.path.join(SF, "events.parquet"), events.schema)
    assert dropped == 0 and same_bars(latest_bars(spark, sink), want)
    folder = tempfile.mkdtemp(prefix="ripplet-ev-")
    split_table(events, os.path.join(folder, "events.parquet"), 3, "event_id")
    events.limit(5).write.parquet(os.path.join(folder, "events_other.parquet"))  # not part of the table
    sink, dropped = run_bars_stream(spark, os.path.join(folder, "events.parquet"), events.schema)
    assert spark.read.parquet(sink).select("batch_id").distinct().count() > 1
    assert dropped == 0 and same_bars(latest_bars(spark, sink), want)


def test_watermark_counts_what_it_drops(spark):
    events = read_table(spark, SF, "events")
    folder = tempfile.mkdtemp(prefix="ripplet-ev-")
    split_table(events, os.path.join(folder, "events.parquet"), 6, "event_id")  # late events count from the third batch on
    sink, dropped = run_bars_stream(spark, os.path.join(folder, "events.parquet"), events.schema, watermark="2 hours")
    kept = latest_bars(spark, sink, "2 hours").agg(F.sum("volume")).first()[0]
    assert 0 < dropped and kept <= events.count() - 1


def test_bars_before_1970(spark):
    rows = [(1, dt.datetime(1969, 12, 31, 23, 10), "a", 2.0), (2, dt.datetime(1969, 12, 31, 23, 50), "a", 1.0), (3, dt.datetime(1970, 1, 1, 0, 5), "a", 5.0)]
    df = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, event_type string, value double")
    folder = tempfile.mkdtemp(prefix="ripplet-old-")
    df.write.parquet(os.path.join(folder, "events.parquet"))
    out = {r.date: (r.open, r.close) for r in hourly_bars_from_events(spark, folder).collect()}
    assert out[dt.datetime(1969, 12, 31, 23)] == (2.0, 1.0) and out[dt.datetime(1970, 1, 1)] == (5.0, 5.0)


class State:
    """Stand-in for the engine's group state."""
    def __init__(self):
        self.value, self.hasTimedOut, self.timeout = None, False, None

    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)

    def update(self, value):
        self.value = value

    def remove(self):
        self.value = None

    def setTimeoutDuration(self, ms):
        self.timeout = ms


def test_warm_up_over_batches_and_flush():
    rng = np.random.default_rng(0)
    r = rng.normal(size=100)
    days = [dt.date(2020, 1, 1) + dt.timedelta(i) for i in range(100)]
    full = pd.DataFrame({"date": days, "log_return": r})

    def run(cuts, flush=None, timeout=False):
        state, out = State(), []
        fn = ewma_state_fn(flush_after_ms=flush)
        for a, b in zip(cuts, cuts[1:]):
            out += list(fn(("s",), iter([full[a:b]]), state))
        if timeout:
            state.hasTimedOut = True
            out += list(fn(("s",), iter([]), state))
        return pd.concat(out).reset_index(drop=True)
    whole, parts = run([0, 100]), run([0, 30, 45, 61, 100])
    assert len(parts) == 100 and list(parts["date"]) == days
    np.testing.assert_allclose(parts["sigma2"], whole["sigma2"])
    assert len(run([0, 30])) == 0
    short = run([0, 20, 30], flush=1000, timeout=True)
    assert list(short["date"]) == days[:30] and abs(short["sigma2"][0] - np.var(r[1:30])) < 1e-12
