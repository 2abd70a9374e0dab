"""Targets (D1-D4): next-step realised volatility and its regime.

The regime threshold is a per-symbol exact quantile of ``target_vol`` over the
training mask only, computed as a window aggregate in the panel's own
partitioning (no join)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def add_target_vol(df: DataFrame, horizon: int = 1, symbol: str = "symbol",
                   date: str = "date") -> DataFrame:
    """target_vol_t = vol_realized_{t+h}."""
    w = Window.partitionBy(symbol).orderBy(date)
    return df.withColumn("target_vol", F.lead("vol_realized", horizon).over(w))


def train_mask_pre_drop(df: DataFrame, train_frac: float = 0.70, symbol: str = "symbol",
                        date: str = "date") -> DataFrame:
    """T5: mask = first int(train_frac * n) rows of each symbol *before*
    warm-up rows are dropped (the reference's threshold mask)."""
    w = Window.partitionBy(symbol).orderBy(date)
    n = F.count(F.lit(1)).over(Window.partitionBy(symbol))
    return df.withColumn("_train_mask",
                         F.row_number().over(w) <= F.floor(n.cast("double") * F.lit(float(train_frac))))


def add_targets(df: DataFrame, horizon: int = 1, threshold: float | None = None,
                train_frac: float = 0.70, q: float = 0.5, symbol: str = "symbol",
                date: str = "date") -> DataFrame:
    """target_vol, target_regime and per-row regime_threshold.

    ``target_regime`` is NULL where ``target_vol`` is unknown (T4)."""
    if "vol_realized" not in df.columns:
        from ripplet.operators.features import add_realized_volatility
        df = add_realized_volatility(df, symbol=symbol, date=date)
    df = add_target_vol(df, horizon, symbol, date)
    if threshold is not None:
        df = df.withColumn("regime_threshold", F.lit(float(threshold)))
    else:
        # Same partitioning as every other panel window: the per-symbol median
        # is a window aggregate over the masked rows, no join and no re-scan.
        # Its buffer is bounded by the bar count of one symbol (calendar-sized).
        masked = train_mask_pre_drop(df, train_frac, symbol, date)
        v = F.when(F.col("_train_mask"), F.col("target_vol"))
        df = masked.withColumn(
            "regime_threshold",
            F.percentile(v, F.lit(float(q))).over(Window.partitionBy(symbol))).drop("_train_mask")
    return df.withColumn(
        "target_regime",
        F.when(F.col("target_vol").isNotNull(),
               (F.col("target_vol") > F.col("regime_threshold")).cast("int")))


def target_metadata(df: DataFrame, horizon: int = 1, vol_window: int = 5,
                    symbol: str = "symbol", threshold_source: str = "train_quantile") -> DataFrame:
    """One provenance row per symbol (threshold, horizon, split sizes)."""
    agg = df.groupBy(symbol).agg(
        F.first("regime_threshold", ignorenulls=True).alias("regime_threshold"),
        F.count_if(F.col("split") == "train").alias("train_size"),
        F.count_if(F.col("split") == "val").alias("val_size"),
        F.count_if(F.col("split") == "test").alias("test_size"))
    return agg.withColumns({"horizon": F.lit(horizon), "vol_window": F.lit(vol_window),
                            "regime_threshold_source": F.lit(threshold_source)})
