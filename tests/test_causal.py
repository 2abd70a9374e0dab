"""Metamorphic leakage tests (D9): mutating the future must not move the past."""
from pyspark.sql import Window
from pyspark.sql import functions as F

from ripplet.operators.features import FEATURE_COLUMNS, build_features, feature_columns
from ripplet.operators.targets import add_targets
from ripplet.plans.panel import modelling_table


def mutate_future(bars, frac=0.7, price_factor=1.5, vol_factor=2.0):
    w = Window.partitionBy("symbol").orderBy("date")
    n = F.count(F.lit(1)).over(Window.partitionBy("symbol"))
    b = bars.withColumns({"_rn": F.row_number().over(w), "_n": n})
    fut = F.col("_rn") > F.floor(F.col("_n") * frac)
    return b.select("symbol", "date", "open",
                    *[F.when(fut, F.col(c) * price_factor).otherwise(F.col(c)).alias(c) for c in ("high", "low", "close")],
                    F.when(fut, F.col("volume") * vol_factor).otherwise(F.col("volume")).alias("volume"),
                    "_rn", "_n")


def test_features_ignore_future(bars):
    base = build_features(bars)
    mut = build_features(mutate_future(bars).drop("_rn", "_n"))
    w = Window.partitionBy("symbol").orderBy("date")
    past = (bars.withColumns({"_rn": F.row_number().over(w), "_n": F.count(F.lit(1)).over(Window.partitionBy("symbol"))})
                .where(F.col("_rn") <= F.floor(F.col("_n") * 0.7)).select("symbol", "date"))
    j = (base.join(past, ["symbol", "date"]).alias("a")
             .join(mut.alias("b"), ["symbol", "date"]))
    diffs = [F.sum(F.when(~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) &
                          ~(F.abs(F.col(f"a.{c}") - F.col(f"b.{c}")) <= 1e-12 + 1e-9 * F.abs(F.col(f"a.{c}"))), 1)
                   .otherwise(0)).alias(c) for c in FEATURE_COLUMNS]
    row = j.agg(*diffs).collect()[0].asDict()
    assert all((v or 0) == 0 for v in row.values()), row


def test_targets_not_features(bars):
    cols = feature_columns(add_targets(build_features(bars)))
    assert "target_vol" not in cols and "target_regime" not in cols
    assert set(FEATURE_COLUMNS) <= set(cols)


def test_target_is_next_vol(bars):
    t = add_targets(build_features(bars))
    w = Window.partitionBy("symbol").orderBy("date")
    t = t.withColumn("_next", F.lead("vol_realized").over(w))
    bad = t.where(~F.col("target_vol").eqNullSafe(F.col("_next"))).count()
    assert bad == 0


def test_threshold_uses_train_only(bars):
    a = add_targets(build_features(bars)).groupBy("symbol").agg(F.first("regime_threshold").alias("t"))
    b = add_targets(build_features(mutate_future(bars, price_factor=5.0, vol_factor=1.0).drop("_rn", "_n"))) \
        .groupBy("symbol").agg(F.first("regime_threshold").alias("t"))
    rows = a.join(b, "symbol").select(F.abs(a["t"] - b["t"]).alias("d")).collect()
    assert all(r.d < 1e-9 for r in rows)


def test_regime_null_where_target_unknown(bars):
    t = add_targets(build_features(bars))
    assert t.where(F.col("target_vol").isNull() & F.col("target_regime").isNotNull()).count() == 0


def test_modelling_table_has_no_nulls(bars):
    m = modelling_table(bars)
    cnt = m.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in FEATURE_COLUMNS + ["target_vol", "target_regime"]])
    assert all(v == 0 for v in cnt.collect()[0].asDict().values())
