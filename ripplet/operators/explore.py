"""Cleaning and exploratory statistics (B1-B10), each a single aggregation
(plus at most one window pass on the panel's own partitioning)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

QS = (0.25, 0.5, 0.75)


def null_counts(df: DataFrame, columns: list[str], keys=("symbol",)) -> DataFrame:
    """B1: NULL count per column in one pass, unpivoted to (keys, column, n_null)."""
    agg = df.groupBy(*keys).agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return agg.unpivot(list(keys), columns, "column_name", "n_null")


def describe(df: DataFrame, value: str, keys=("symbol",), prefix: str = "") -> DataFrame:
    """count, mean, std (ddof 1), min, quartiles (linear), max per group."""
    x = F.col(value)
    return df.where(x.isNotNull()).groupBy(*keys).agg(
        F.count(x).alias(f"{prefix}count"), F.avg(x).alias(f"{prefix}mean"),
        F.stddev_samp(x).alias(f"{prefix}std"), F.min(x).alias(f"{prefix}min"),
        *[F.percentile(x, F.lit(q)).alias(f"{prefix}q{int(q * 100)}") for q in QS],
        F.max(x).alias(f"{prefix}max"))


def calendar_gaps(bars: DataFrame, symbol: str = "symbol", date: str = "date") -> DataFrame:
    """B2: profile of day gaps between consecutive bars."""
    w = Window.partitionBy(symbol).orderBy(date)
    gaps = bars.select(symbol, F.datediff(F.col(date), F.lag(date).over(w)).cast("double").alias("gap_days"))
    return describe(gaps, "gap_days", (symbol,))


def ohlc_coherence(bars: DataFrame, symbol: str = "symbol") -> DataFrame:
    """Bars whose high/low do not bracket open and close."""
    return bars.groupBy(symbol).agg(
        F.count(F.lit(1)).alias("n_bars"),
        F.count_if(F.col("high") < F.greatest("open", "close")).alias("n_high_below"),
        F.count_if(F.col("low") > F.least("open", "close")).alias("n_low_above"))


def return_moments(df: DataFrame, value: str = "log_return", keys=("symbol",)) -> DataFrame:
    """Describe + bias-corrected sample skewness (G1) and excess kurtosis."""
    x = F.col(value)
    d = describe(df, value, keys)
    m = df.where(x.isNotNull()).groupBy(*keys).agg(
        F.count(x).cast("double").alias("_n"), F.skewness(x).alias("_g1"), F.kurtosis(x).alias("_g2"))
    n = F.col("_n")
    m = m.select(*keys,
                 # NULL for groups too short (n <= 2, n <= 3) and for constant ones
                 F.when(n > 2, F.try_divide(F.nanvl("_g1", F.lit(None)) * F.sqrt(n * (n - 1)), n - 2)).alias("skew"),
                 F.when(n > 3, F.try_divide(n - 1, (n - 2) * (n - 3)) * ((n + 1) * F.nanvl("_g2", F.lit(None)) + 6)).alias("kurt"))
    return d.join(m, list(keys))


def histogram(df: DataFrame, value: str, bins: int = 120, keys=("symbol",)) -> DataFrame:
    """Equal-width histogram on [min, max] per group (max goes to
    the last bin).  Group min/max are window aggregates on the group key."""
    wk = Window.partitionBy(*keys)
    x = F.col(value)
    b = df.where(x.isNotNull()).select(*keys, x.alias("_x"), F.min(x).over(wk).alias("_lo"),
                                       F.max(x).over(wk).alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    idx = F.when(F.col("_hi") == F.col("_lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col("_x") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * F.lit(float(bins))),
                F.lit(bins - 1))).cast("int")
    h = b.groupBy(*keys, idx.alias("bin")).agg(F.count(F.lit(1)).alias("n"),
                                               F.first("_lo").alias("_lo"), F.first("_hi").alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    return h.select(*keys, "bin", (F.col("_lo") + F.col("bin") * width).alias("edge_lo"),
                    (F.col("_lo") + (F.col("bin") + 1) * width).alias("edge_hi"), "n")


def acf(df: DataFrame, value: str, n_lags: int = 40, keys=("symbol",), order: str = "date") -> DataFrame:
    """Biased ACF rho_k = gamma_k / gamma_0 (full-sample mean, divisor n)
    for k = 1..n_lags, plus the +-1.96/sqrt(n) band.  One window node computes
    the mean and all lags; one aggregation computes every gamma_k."""
    wk = Window.partitionBy(*keys)
    wo = Window.partitionBy(*keys).orderBy(order)
    x = F.col(value)
    base = df.where(x.isNotNull()).select(*keys, order, (x - F.avg(x).over(wk)).alias("_d"))
    base = base.withColumns({f"_l{k}": F.lag("_d", k).over(wo) for k in range(1, n_lags + 1)})
    agg = base.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("_d") * F.col("_d")).alias("_g0"),
                                  *[F.sum(F.col("_d") * F.col(f"_l{k}")).alias(f"g{k}")
                                    for k in range(1, n_lags + 1)])
    long = agg.unpivot([*keys, "n", "_g0"], [f"g{k}" for k in range(1, n_lags + 1)], "_lag", "_gk")
    return long.select(*keys, F.substring("_lag", 2, 3).cast("int").alias("lag"),
                       F.try_divide("_gk", "_g0").alias("acf"),
                       (F.lit(1.96) / F.sqrt(F.col("n").cast("double"))).alias("band"))


def class_balance(df: DataFrame, label: str = "target_regime", keys=("symbol", "split")) -> DataFrame:
    """Counts of 0/1 and P(1) per split."""
    y = F.col(label)
    return df.where(y.isNotNull()).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(y == 1).alias("n_pos"),
        F.count_if(y == 0).alias("n_neg"), F.avg(y.cast("double")).alias("p_pos"))


def target_shift(df: DataFrame, value: str = "target_vol", keys=("symbol", "split"),
                 qs=(0.1, 0.25, 0.5, 0.75, 0.9)) -> DataFrame:
    """Per-split distribution profile of the target (quantiles, mean, std)."""
    x = F.col(value)
    return df.where(x.isNotNull()).groupBy(*keys).agg(
        F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
        *[F.percentile(x, F.lit(q)).alias(f"q{int(round(q * 100))}") for q in qs])
