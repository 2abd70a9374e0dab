"""Pre-processing fitted on train rows only.

Fitted parameters are small tables (one row per symbol x column) joined back;
applying them is a projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fit_median_imputer(df: DataFrame, columns: list[str], keys=("symbol",),
                       split: str | None = "train") -> DataFrame:
    """exact (interpolated) median per column on the training rows,
    unpivoted to (keys, column_name, median)."""
    src = df.where(F.col("split") == split) if split else df
    agg = src.groupBy(*keys).agg(*[F.percentile(F.col(c), F.lit(0.5)).alias(c) for c in columns])
    return agg.unpivot(list(keys), columns, "column_name", "median")


def apply_median_imputer(df: DataFrame, medians: DataFrame, columns: list[str], keys=("symbol",)) -> DataFrame:
    wide = medians.groupBy(*keys).pivot("column_name", columns).agg(F.first("median"))
    wide = wide.select(*keys, *[F.col(c).alias(f"_med_{c}") for c in columns])
    out = df.join(wide, list(keys), "left")  # one row per symbol
    return out.withColumns({c: F.coalesce(F.col(c), F.col(f"_med_{c}")) for c in columns}) \
              .drop(*[f"_med_{c}" for c in columns])


def fit_standard_scaler(df: DataFrame, columns: list[str], keys=("symbol",),
                        split: str | None = "train") -> DataFrame:
    """mean and *population* std per column; a constant column gets scale 1."""
    src = df.where(F.col("split") == split) if split else df
    aggs = []
    for c in columns:
        aggs += [F.avg(c).alias(f"m__{c}"), F.stddev_pop(c).alias(f"s__{c}")]
    agg = src.groupBy(*keys).agg(*aggs)
    structs = [F.struct(F.lit(c).alias("column_name"), F.col(f"m__{c}").alias("mean"),
                        F.when(F.col(f"s__{c}") == 0, F.lit(1.0)).otherwise(F.col(f"s__{c}")).alias("scale"))
               for c in columns]
    return agg.select(*keys, F.inline(F.array(*structs)))


def apply_standard_scaler(df: DataFrame, params: DataFrame, columns: list[str], keys=("symbol",)) -> DataFrame:
    wide = params.groupBy(*keys).pivot("column_name", columns).agg(F.first("mean").alias("m"),
                                                                   F.first("scale").alias("s"))
    out = df.join(wide, list(keys), "left")  # one row per symbol
    return out.withColumns({c: (F.col(c) - F.col(f"{c}_m")) / F.col(f"{c}_s") for c in columns}) \
              .drop(*[f"{c}_{x}" for c in columns for x in ("m", "s")])
