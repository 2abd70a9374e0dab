"""Leakage audit as a user-level job.

Features are built twice — on the full bars and on bars truncated at the
cut — and joined on (symbol, date); every feature column must agree on the
rows before the cut.  Targets must not be feature columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ripplet.operators.features import FEATURE_COLUMNS, build_features


def feature_leakage_audit(bars: DataFrame, cut_frac: float = 0.7, rtol: float = 1e-9,
                          atol: float = 1e-12) -> DataFrame:
    w = Window.partitionBy("symbol").orderBy("date")
    n = F.count(F.lit(1)).over(Window.partitionBy("symbol"))
    b = bars.withColumns({"_rn": F.row_number().over(w), "_n": n})
    past = b.where(F.col("_rn") <= F.floor(F.col("_n") * cut_frac)).drop("_rn", "_n")
    full = build_features(bars)
    trunc = build_features(past)
    j = full.alias("a").join(trunc.alias("b"), ["symbol", "date"])
    diff = {c: F.count_if(~(F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) |
                            (F.abs(F.col(f"a.{c}") - F.col(f"b.{c}")) <= atol + rtol * F.abs(F.col(f"b.{c}")))))
            for c in FEATURE_COLUMNS}
    agg = j.groupBy("symbol").agg(*[v.alias(k) for k, v in diff.items()], F.count(F.lit(1)).alias("rows_checked"))
    return agg.unpivot(["symbol", "rows_checked"], list(FEATURE_COLUMNS), "column_name", "n_diff")
