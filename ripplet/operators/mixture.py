"""Regime-gated mixture and ensembles (M1-M3).

M1  gate = boosted classifier of the regime (probability p of high
    volatility); experts = boosted regressors trained on the train rows of
    each regime and early-stopped on the whole validation split; prediction
    p * R_high + (1 - p) * R_low, each expert clipped at 0.
M2  equal-weight ensemble of two forecasters (aligned by key, not position).
M3  ablation: every variant's long predictions evaluated by I1 together.

Gate, experts, tuned and plain trees are five models of one boosting run over one binned table.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ripplet.operators import models as MD
from ripplet.operators.boosting import Spec, bin_table, fit_boosted_many
from ripplet.operators.features import FEATURE_COLUMNS
from ripplet.operators.forecast import naive_col
from ripplet.operators.metrics import regression_metrics

KEYS = ["symbol", "date", "split"]


def mixture_models(panel: DataFrame, features: list[str] | None = None, tuned: dict | None = None, **limits) -> dict:
    """Gate, experts (both with the ``tuned`` parameters), tuned trees and plain trees, grown together."""
    train, val = F.col("split") == "train", F.col("split") == "val"
    on = [(train, val)] + [(train & (F.col("target_regime") == r), val) for r in (0, 1)]
    table = bin_table(panel, features or FEATURE_COLUMNS, ["target_vol", "target_regime"], on, ["symbol", "date"])
    best = Spec(**{**(tuned or {}), **limits})
    specs = {"gate": replace(best, task="classification", label=1), "low": replace(best, fold=1), "high": replace(best, fold=2),
             "gbt_tuned": best, "gbt": Spec(**limits)}
    return dict(zip(specs, fit_boosted_many(table, list(specs.values()))))


def mixture_components(panel: DataFrame, features: list[str] | None = None, tuned: dict | None = None, **limits) -> DataFrame:
    """Wide per-row components: p_high, r_low, r_high, gbt, gbt_tuned, ridge, naive."""
    models = mixture_models(panel, features, tuned, **limits)
    train = panel.where(F.col("split") == "train")
    ridge = MD.fit_pipeline(MD.regression_estimators(train)["ridge"], train, features or FEATURE_COLUMNS)
    out = ridge.transform(panel).withColumnRenamed("prediction", "ridge")
    for name, column in (("gate", "p_high"), ("low", "r_low"), ("high", "r_high"), ("gbt", "gbt"), ("gbt_tuned", "gbt_tuned")):
        out = models[name].predict(out, column)
    clip = lambda c: F.greatest(F.col(c), F.lit(0.0)).alias(c)
    return out.select(*KEYS, "target_vol", "p_high", *[clip(c) for c in ("r_low", "r_high", "gbt", "gbt_tuned", "ridge")], naive_col().alias("naive"))


def ablation(components: DataFrame) -> DataFrame:
    """M1-M3: long predictions of every variant, then I1 per (symbol, model, split)."""
    c = components
    p = F.col("p_high")
    variants = {
        "mixture": p * F.col("r_high") + (1 - p) * F.col("r_low"),
        "mixture_hard_gate": F.when(p > 0.5, F.col("r_high")).otherwise(F.col("r_low")),
        "ensemble_ridge_gbt": 0.5 * (F.col("ridge") + F.col("gbt_tuned")),
        "ridge": F.col("ridge"), "gbt": F.col("gbt"), "gbt_tuned": F.col("gbt_tuned"), "naive": F.col("naive"),
        "only_low_expert": F.col("r_low"), "only_high_expert": F.col("r_high"),
    }
    wide = c.select(*KEYS, F.col("target_vol").alias("y_true"), *[v.alias(k) for k, v in variants.items()])
    long = wide.unpivot([*KEYS, "y_true"], list(variants), "model", "y_pred")
    return regression_metrics(long)
