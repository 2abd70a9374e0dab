"""Temporal splits (D5-D8): chronological train/val/test per symbol and an
expanding-window fold table, both as columns on the panel (no positional
lists, no single-partition global sort)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def temporal_split(df: DataFrame, train_frac: float = 0.70, val_frac: float = 0.15,
                   test_frac: float = 0.15, symbol: str = "symbol", date: str = "date",
                   out: str = "split", purge: int = 0) -> DataFrame:
    """First int(.7n) rows train, next int(.15n) val, the rest test (per symbol).

    ``purge`` = h labels the last h train rows 'purged' (their h-step targets
    look past the cut, SURVEY T5); the default 0 keeps the reference split."""
    if abs(train_frac + val_frac + test_frac - 1.0) >= 1e-9:
        raise ValueError(f"split shares add up to {train_frac + val_frac + test_frac}, not 1")
    w = Window.partitionBy(symbol).orderBy(date)
    n = F.count(F.lit(1)).over(Window.partitionBy(symbol)).cast("double")
    n_train = F.floor(n * F.lit(float(train_frac)))
    n_val = F.floor(n * F.lit(float(val_frac)))
    rn = F.row_number().over(w)
    return df.withColumn(out, F.when(rn <= n_train - F.lit(purge), "train")
                              .when(rn <= n_train, "purged")
                              .when(rn <= n_train + n_val, "val").otherwise("test"))


def panel_cut_dates(df: DataFrame, train_frac: float = 0.70, val_frac: float = 0.15,
                    date: str = "date") -> DataFrame:
    """Panel variant of D5: global cut dates from per-date row counts, so
    every symbol shares the same calendar cut (no cross-symbol leakage).
    The window runs over distinct dates only (bounded by the calendar)."""
    per_date = df.groupBy(date).agg(F.count(F.lit(1)).alias("_c"))
    w = Window.orderBy(date).rowsBetween(Window.unboundedPreceding, 0)
    cum = per_date.select(date, F.sum("_c").over(w).alias("_cum"),
                          F.sum("_c").over(Window.partitionBy()).alias("_n"))
    return cum.withColumn("split", F.when(F.col("_cum") <= F.floor(F.col("_n") * float(train_frac)), "train")
                          .when(F.col("_cum") <= F.floor(F.col("_n") * float(train_frac))
                                + F.floor(F.col("_n") * float(val_frac)), "val")
                          .otherwise("test")).select(date, "split")


def split_summary(df: DataFrame, symbol: str = "symbol", date: str = "date",
                  split: str = "split") -> DataFrame:
    """Rows and date range per split."""
    return df.groupBy(symbol, split).agg(F.count(F.lit(1)).alias("n_rows"),
                                         F.min(date).alias("date_min"),
                                         F.max(date).alias("date_max"))


def time_series_folds(df: DataFrame, n_splits: int = 5, test_size: int | None = None,
                      gap: int = 0, symbol: str = "symbol", date: str = "date") -> DataFrame:
    """Expanding-window folds per symbol, one row per (row, fold, role).

    ts = test_size or n // (k+1); fold i tests [n-(k-i)*ts, n-(k-i-1)*ts) and
    trains on [0, test_start - gap).  The k-row fold table is generated per
    row with ``sequence``/``explode`` (k is a parameter, not data-sized)."""
    w = Window.partitionBy(symbol).orderBy(date)
    n = F.count(F.lit(1)).over(Window.partitionBy(symbol))
    base = df.withColumns({"_pos": F.row_number().over(w) - 1, "_n": n})
    ts = F.lit(test_size) if test_size else F.floor(F.col("_n") / F.lit(n_splits + 1))
    k = n_splits
    folds = base.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
    start = F.col("_n") - (F.lit(k) - F.col("fold")) * ts
    role = (F.when((F.col("_pos") >= start) & (F.col("_pos") < start + ts), "test")
             .when(F.col("_pos") < start - F.lit(gap), "train"))
    return (folds.withColumn("role", role).where(F.col("role").isNotNull())
                 .drop("_n").withColumnRenamed("_pos", "pos"))


def valid_rows(df: DataFrame, targets: list[str] = ("target_vol",)) -> DataFrame:
    """Keep rows with non-null targets."""
    return df.dropna(subset=list(targets))


def chronological_holdout(train: DataFrame, holdout_frac: float = 0.15, symbol: str = "symbol",
                          date: str = "date", out: str = "role") -> DataFrame:
    """The last ``holdout_frac`` of each symbol's train rows become the
    early-stopping hold-out (role 'holdout'), the rest stay 'fit'."""
    w = Window.partitionBy(symbol).orderBy(date)
    n = F.count(F.lit(1)).over(Window.partitionBy(symbol)).cast("double")
    cut = n - F.floor(n * F.lit(float(holdout_frac)))
    return train.withColumn(out, F.when(F.row_number().over(w) <= cut, "fit").otherwise("holdout"))
