"""Canonical panels built from the driver's tables.

``daily_panel``: lineitem -> daily OHLCV bars per return flag -> causal
features -> targets (train-only threshold) -> warm-up drop -> 70/15/15 split.
One lazy plan: scan (pruned to 8 columns) -> partial aggregation -> one
exchange on ``symbol`` for every window of the panel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ripplet.operators.features import FEATURE_COLUMNS, build_features, drop_warmup
from ripplet.operators.splits import temporal_split
from ripplet.operators.targets import add_targets
from ripplet.sources.bars import daily_bars_from_lineitem, hourly_bars_from_events


def modelling_table(bars: DataFrame, horizon: int = 1) -> DataFrame:
    feats = build_features(bars)
    tgt = add_targets(feats, horizon=horizon)
    clean = drop_warmup(tgt, FEATURE_COLUMNS + ["target_vol", "target_regime"])
    return temporal_split(clean)


def daily_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return modelling_table(daily_bars_from_lineitem(spark, sf_dir))


def hourly_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return modelling_table(hourly_bars_from_events(spark, sf_dir))


def targets_table(bars: DataFrame, horizon: int = 1) -> DataFrame:
    """Features + targets before the warm-up drop (what B1 profiles)."""
    return add_targets(build_features(bars), horizon=horizon)
