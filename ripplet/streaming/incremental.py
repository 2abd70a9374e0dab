"""Incremental / stateful operators on streams.

* F19 incremental Gaussian NB: each micro-batch contributes mergeable
  sufficient statistics (n, mean, M2) per (class, j); the running model
  is their sum, which equals the full-data fit.
* E3 EWMA variance as per-symbol streaming state (applyInPandasWithState):
  the state is sigma2 and the held warm-up rows; each batch's rows of a symbol are
  folded in time order — the per-group work is one micro-batch, never the
  whole history.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ripplet.operators.naive_bayes import combine_stats, explode_vectors, sufficient_stats
from ripplet.session import checkpoint_root
from ripplet.sources.tables import stream_table


def run_incremental_gnb(spark: SparkSession, path: str, schema, label: str = "label",
                        max_files_per_trigger: int = 1) -> str:
    """Stream the vectors of the table at ``path`` (a file or a directory of part files), append per-batch statistics;
    returns the stats table path."""
    root = os.path.join(checkpoint_root(spark), "streams", f"gnb-{uuid.uuid4().hex[:12]}")
    sink, ckpt = os.path.join(root, "stats"), os.path.join(root, "checkpoint")
    src = stream_table(spark, path, schema, max_files_per_trigger)

    def write(batch: DataFrame, batch_id: int) -> None:
        long = explode_vectors(batch, "vec_id", "embedding", extra=(label,))
        sufficient_stats(long, label).withColumn("batch_id", F.lit(batch_id)) \
            .write.mode("append").parquet(sink)

    q = (src.writeStream.foreachBatch(write).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return sink


def merged_stats(spark: SparkSession, sink: str) -> DataFrame:
    return combine_stats(spark.read.parquet(sink))


EWMA_OUT = "symbol string, date date, sigma2 double"
EWMA_STATE = "sigma2 double, dates array<date>, warm array<double>"


def ewma_state_fn(lam: float = 0.94, warm_up: int = 60, flush_after_ms: int | None = None):
    """State machine for one symbol.  Until ``warm_up`` + 1 returns are seen the
    start value sigma2_0 = var_pop(r_1..r_warm_up) is unknown, so rows are held
    in state with their dates (bounded by ``warm_up``) and emitted once it is
    known.  With ``flush_after_ms`` a symbol that stays silent that long emits
    what it holds, starting from the variance of the returns it has, as the
    batch form does for a short series."""

    def emit(dates, warm):
        s2 = float(np.var(np.array(warm[1:warm_up + 1]))) if len(warm) > 1 else 0.0
        out = [s2]
        for r in warm[1:]:
            s2 = lam * s2 + (1.0 - lam) * r * r
            out.append(s2)
        return list(dates), out

    def frame(key, dates, values):
        return pd.DataFrame({"symbol": [key[0]] * len(dates), "date": dates, "sigma2": values})

    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        s2, dates, warm = state.get if state.exists else (None, [], [])
        dates, warm = list(dates or []), list(warm or [])
        if state.hasTimedOut:
            state.remove()
            if s2 is None and dates:
                yield frame(key, *emit(dates, warm))
            return
        pdf = pd.concat(list(pdfs)).sort_values("date")
        out_d, out_s = [], []
        for d, r in zip(pdf["date"], pdf["log_return"]):
            r = 0.0 if r is None or (isinstance(r, float) and np.isnan(r)) else float(r)
            if s2 is None:
                dates.append(d)
                warm.append(r)
                if len(warm) == warm_up + 1:
                    out_d, out_s = emit(dates, warm)
                    s2, dates, warm = out_s[-1], [], []
            else:
                s2 = lam * s2 + (1.0 - lam) * r * r
                out_d.append(d)
                out_s.append(s2)
        state.update((s2, dates, warm))
        if flush_after_ms is not None:
            state.setTimeoutDuration(flush_after_ms)
        yield frame(key, out_d, out_s)

    return fn


def ewma_stream(returns: DataFrame, lam: float = 0.94, warm_up: int = 60, flush_after_ms: int | None = None) -> DataFrame:
    """Per-symbol streaming EWMA variance over (symbol, date, log_return) rows
    that arrive in time order per symbol."""
    timeout = GroupStateTimeout.NoTimeout if flush_after_ms is None else GroupStateTimeout.ProcessingTimeTimeout
    return returns.groupBy("symbol").applyInPandasWithState(
        ewma_state_fn(lam, warm_up, flush_after_ms), EWMA_OUT, EWMA_STATE, "append", timeout)
