"""Causal window features (C1-C21) over a (symbol, date) panel.

Everything is one window specification ``partitionBy(symbol).orderBy(date)``
with different row frames, so the plan has a single exchange on ``symbol``
and a single sort; nested windows (rolling of a rolling) add Window nodes,
not shuffles.  Every rolling statistic follows the ``min_periods = w`` rule:
NULL unless all ``w`` inputs of the frame are non-null.

Skewness / kurtosis are the bias-corrected sample forms (G1, excess G2)
derived from Spark's population ``skewness``/``kurtosis``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Window lengths and lags of the feature families.
RET_LAGS = (1, 2, 3, 5, 10)
VOL_WINDOWS = (5, 10, 22)
MOMENTUM_WINDOWS = (5, 10, 22)
SMA_WINDOWS = (10, 22, 50)
VOL_REALIZED_WINDOW = 5
ATR_WINDOW = 14
LOG_VOLUME_MA_WINDOW = 10
VOLUME_RATIO_WINDOW = 20
MOMENT_WINDOW = 22

# Columns never used as model inputs.
EXCLUDED = ("symbol", "date", "open", "high", "low", "close", "volume",
            "log_return", "vol_realized", "target_vol", "target_regime", "split")

FEATURE_COLUMNS = (
    [f"ret_lag_{k}" for k in RET_LAGS]
    + [f"vol_{w}" for w in VOL_WINDOWS]
    + ["vol_d", "vol_w", "vol_m"]
    + [f"momentum_{w}" for w in MOMENTUM_WINDOWS]
    + ["range_hl", "true_range", "atr_14"]
    + ["log_volume", "volume_lag_1", "log_volume_ma_10", "volume_ratio"]
    + [f"sma_{w}" for w in SMA_WINDOWS]
    + [f"px_dist_sma_{w}" for w in SMA_WINDOWS]
    + ["skew_22", "kurt_22", "dow", "month"]
)


def _spec(symbol: str, date: str):
    return Window.partitionBy(symbol).orderBy(date)


def rolling(spec, n: int):
    return spec.rowsBetween(-(n - 1), 0)


def _g(agg: Column, x: Column, w, n: int) -> Column:
    return F.when(F.count(x).over(w) == n, agg.over(w))


def add_log_returns(df: DataFrame, price: str = "close", symbol: str = "symbol",
                    date: str = "date") -> DataFrame:
    """ln(p_t / p_{t-1}); NULL when either price is missing or not positive."""
    w = _spec(symbol, date)
    prev = F.lag(price, 1).over(w)
    p = F.col(price)
    return df.withColumn("log_return",
                         F.when((p > 0) & (prev > 0), F.ln(p / prev)))


def add_realized_volatility(df: DataFrame, window: int = VOL_REALIZED_WINDOW,
                            symbol: str = "symbol", date: str = "date") -> DataFrame:
    """Sample std of the last ``window`` returns (guarded)."""
    if "log_return" not in df.columns:
        df = add_log_returns(df, symbol=symbol, date=date)
    w = rolling(_spec(symbol, date), window)
    r = F.col("log_return")
    return df.withColumn("vol_realized", _g(F.stddev_samp(r), r, w, window))


def build_features(df: DataFrame, symbol: str = "symbol", date: str = "date") -> DataFrame:
    """C1-C19 on an OHLCV panel ``(symbol, date, open, high, low, close, volume)``.

    Each distinct (input, frame) window aggregate is computed once and the
    features are projections of them (Catalyst does not share identical
    window expressions across a projection)."""
    spec = _spec(symbol, date)
    if "log_return" not in df.columns:
        df = add_log_returns(df, symbol=symbol, date=date)
    if "vol_realized" not in df.columns:
        df = add_realized_volatility(df, symbol=symbol, date=date)

    r, c, h, lo, v = (F.col(x) for x in ("log_return", "close", "high", "low", "volume"))
    vr = F.col("vol_realized")
    n22 = MOMENT_WINDOW
    # Level 1: window aggregates, each once.
    w1: dict[str, Column] = {"_prev_close": F.lag(c, 1).over(spec),
                             "volume_lag_1": F.lag(v, 1).over(spec),               # C12
                             "vol_d": F.lag(vr, 1).over(spec)}                     # C5
    for k in RET_LAGS:                                                             # C3
        w1[f"ret_lag_{k}"] = F.lag(r, k).over(spec)
    r_frames = sorted(set(VOL_WINDOWS) | set(MOMENTUM_WINDOWS) | {n22})
    for n in r_frames:
        w1[f"_cr{n}"] = F.count(r).over(rolling(spec, n))
    for n in VOL_WINDOWS:
        if n != VOL_REALIZED_WINDOW:
            w1[f"_sd{n}"] = F.stddev_samp(r).over(rolling(spec, n))
    for n in MOMENTUM_WINDOWS:
        w1[f"_sm{n}"] = F.sum(r).over(rolling(spec, n))
    w1["_sk"] = F.skewness(r).over(rolling(spec, n22))
    w1["_ku"] = F.kurtosis(r).over(rolling(spec, n22))
    for name, n in (("w", 5), ("m", 22)):                                          # C6: (t-n, t-1]
        wf = spec.rowsBetween(-n, -1)
        w1[f"_cv{name}"] = F.count(vr).over(wf)
        w1[f"_av{name}"] = F.avg(vr).over(wf)
    for n in SMA_WINDOWS:
        w1[f"_cc{n}"] = F.count(c).over(rolling(spec, n))
        w1[f"_ac{n}"] = F.avg(c).over(rolling(spec, n))
    w20 = rolling(spec, VOLUME_RATIO_WINDOW)
    w1["_cvol"] = F.count(v).over(w20)
    w1["_avol"] = F.avg(v).over(w20)
    out = df.withColumns(w1)

    # Projections with the min_periods guards.
    g = lambda cnt, n, val: F.when(F.col(cnt) == n, val)
    pc = F.col("_prev_close")
    cols: dict[str, Column] = {}
    for n in VOL_WINDOWS:                                                          # C4
        cols[f"vol_{n}"] = vr if n == VOL_REALIZED_WINDOW else g(f"_cr{n}", n, F.col(f"_sd{n}"))
    cols["vol_w"] = g("_cvw", 5, F.col("_avw"))
    cols["vol_m"] = g("_cvm", 22, F.col("_avm"))
    for n in MOMENTUM_WINDOWS:                                                     # C7
        cols[f"momentum_{n}"] = g(f"_cr{n}", n, F.col(f"_sm{n}"))
    cols["range_hl"] = F.try_divide(h - lo, c)                                     # C8
    cols["true_range"] = F.when(pc.isNotNull() & h.isNotNull() & lo.isNotNull(),   # C9 (T2 guard)
                                F.try_divide(F.greatest(h - lo, F.abs(h - pc), F.abs(lo - pc)), c))
    cols["log_volume"] = F.when(v > 0, F.ln(v))                                    # C11
    cols["volume_ratio"] = F.try_divide(v, g("_cvol", VOLUME_RATIO_WINDOW, F.col("_avol")))  # C14
    for n in SMA_WINDOWS:                                                          # C15
        cols[f"sma_{n}"] = g(f"_cc{n}", n, F.col(f"_ac{n}"))
    cols["skew_22"] = g(f"_cr{n22}", n22, F.col("_sk") * F.lit((n22 * (n22 - 1)) ** 0.5 / (n22 - 2)))  # C17
    cols["kurt_22"] = g(f"_cr{n22}", n22, (F.col("_ku") * F.lit(float(n22 + 1)) + F.lit(6.0))        # C18
                        * F.lit((n22 - 1) / ((n22 - 2) * (n22 - 3))))
    cols["dow"] = F.weekday(F.col(date)).cast("int")                               # C19 (Monday = 0)
    cols["month"] = F.month(F.col(date)).cast("int")
    out = out.withColumns(cols)
    out = out.withColumns({f"px_dist_sma_{n}": F.try_divide(c - F.col(f"sma_{n}"), F.col(f"sma_{n}"))
                           for n in SMA_WINDOWS})                                  # C16
    # Level 2: rolling means of derived columns.
    tr, lv = F.col("true_range"), F.col("log_volume")
    out = out.withColumns({
        "_ctr": F.count(tr).over(rolling(spec, ATR_WINDOW)),
        "_atr": F.avg(tr).over(rolling(spec, ATR_WINDOW)),
        "_clv": F.count(lv).over(rolling(spec, LOG_VOLUME_MA_WINDOW)),
        "_alv": F.avg(lv).over(rolling(spec, LOG_VOLUME_MA_WINDOW)),
    })
    out = out.withColumns({"atr_14": g("_ctr", ATR_WINDOW, F.col("_atr")),
                           "log_volume_ma_10": g("_clv", LOG_VOLUME_MA_WINDOW, F.col("_alv"))})
    return out.drop(*[x for x in out.columns if x.startswith("_")])


def feature_columns(df: DataFrame) -> list[str]:
    """C20: every column except OHLCV, bases, targets and keys."""
    return [c for c in df.columns if c not in EXCLUDED]


def drop_warmup(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Drop rows with any NULL feature or target."""
    cols = columns or (FEATURE_COLUMNS + ["target_vol", "target_regime"])
    return df.dropna(subset=[c for c in cols if c in df.columns])
