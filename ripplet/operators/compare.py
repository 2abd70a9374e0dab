"""Forecast comparison (K1-K8).

Pairs of *models* are compared on the same rows.  Instead of self-joining the
long prediction table (which would emit model pairs per row), the wide table
(one column per model, one row per (symbol, date)) is expanded inside a row, or
feeds one aggregation that carries every pair as its own columns; results have
one row per (symbol, model_a, model_b) with model_a < model_b (the test is
antisymmetric).  Completeness is per pair, or per model: a forecaster with
NULLs never drops rows of the others.
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ripplet.functions.expr import ntz_to_micros
from ripplet.functions.random import index_sql, uniform_sql
from ripplet.functions.special import normal_two_sided_p_sql
from ripplet.session import materialize


def _pairs(models) -> list[tuple[str, str]]:
    return list(combinations(sorted(models), 2))


def _loss(loss: str):
    """Loss of a prediction column against the truth: squared ("se") or absolute ("ae") error."""
    if loss not in ("se", "ae"):
        raise ValueError("loss must be 'se' or 'ae'")
    return (lambda p, y: (p - y) * (p - y)) if loss == "se" else (lambda p, y: F.abs(p - y))


def diebold_mariano(wide: DataFrame, models, y: str = "target_vol", loss: str = "se",
                    horizon: int = 1, keys=("symbol",), order: str = "date") -> DataFrame:
    """K1: DM statistic per model pair on pairwise-complete rows.

    d = L_a - L_b; var = population variance + 2 * sum_{k<h} autocov_k, where
    autocov_k is the mean of the n - k lagged products of the centred d (rows
    without d are left out before lagging); stat = mean / sqrt(var / n); NULL
    when var <= 0; p = erfc(|stat| / sqrt 2) (no 1 - Phi underflow)."""
    yy, lossf, pairs = F.col(y), _loss(loss), _pairs(models)
    d = [F.when(yy.isNotNull() & F.col(a).isNotNull() & F.col(b).isNotNull(), lossf(F.col(a), yy) - lossf(F.col(b), yy))
         for a, b in pairs]
    if horizon <= 1:  # one wide aggregation, a column set per pair
        df = wide.select(*keys, *[c.alias(f"_d{i}") for i, c in enumerate(d)])
        agg = df.groupBy(*keys).agg(*[f(f"_d{i}").alias(f"{n}{i}") for i in range(len(pairs))
                                      for n, f in (("n", F.count), ("m", F.avg), ("v", F.var_pop))])
        long = agg.select(*keys, F.inline(F.array(*[
            F.struct(F.lit(a).alias("model_a"), F.lit(b).alias("model_b"), F.col(f"n{i}").alias("n"),
                     F.col(f"m{i}").alias("mean_loss_diff"), F.col(f"v{i}").alias("_var")) for i, (a, b) in enumerate(pairs)])))
    else:  # lags need each pair's own rows: one row per (series, pair, date)
        part = [*keys, "model_a", "model_b"]
        rows = wide.select(*keys, order, F.inline(F.array(*[
            F.struct(F.lit(a).alias("model_a"), F.lit(b).alias("model_b"), d[i].alias("_d")) for i, (a, b) in enumerate(pairs)])))
        rows = rows.where("_d IS NOT NULL").withColumn("_c", F.col("_d") - F.avg("_d").over(Window.partitionBy(*part)))
        wo = Window.partitionBy(*part).orderBy(order)
        rows = rows.withColumns({f"_c{k}": F.col("_c") * F.lag("_c", k).over(wo) for k in range(1, horizon)})
        agg = rows.groupBy(*part).agg(F.count("_d").alias("n"), F.avg("_d").alias("mean_loss_diff"), F.var_pop("_d").alias("_v"),
                                      *[F.avg(f"_c{k}").alias(f"a{k}") for k in range(1, horizon)])
        long = agg.withColumn("_var", F.col("_v") + 2.0 * sum(F.coalesce(F.col(f"a{k}"), F.lit(0.0)) for k in range(1, horizon)))
        long = long.select(*part, "n", "mean_loss_diff", "_var")
    stat = F.when(F.col("_var") > 0, F.col("mean_loss_diff") / F.sqrt(F.col("_var") / F.col("n")))
    long = long.withColumn("statistic", stat).drop("_var")
    return long.withColumns({"p_value": F.expr(normal_two_sided_p_sql("statistic")),
                             "horizon": F.lit(horizon)})


def bonferroni(tests: DataFrame, alpha: float = 0.05, keys=("symbol",)) -> DataFrame:
    """K2 / K8: k = number of pairs in the family; flags at alpha and alpha / k."""
    k = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    return tests.withColumns({"n_pairs": k,
                              "alpha_bonferroni": F.lit(alpha) / k,
                              "significant_5pct": F.col("p_value") < F.lit(alpha),
                              "significant_bonferroni": F.col("p_value") < (F.lit(alpha) / k)})


def _draws(rows: DataFrame, part: list[str], n_boot: int, seed: int) -> DataFrame:
    """(part, _n, b, _idx): ``_n`` index draws with replacement per replicate.  index(b, j) is a hash of (seed, b, j) (X4), so the
    draw is reproducible, independent of partitioning, and the same for all models of a series with as many rows:
    it is made once for them."""
    return (rows.select(*part, "_pos", "_n", F.explode(F.sequence(F.lit(0), F.lit(n_boot - 1))).alias("b"))
                .select(*part, "_n", "b", F.expr(index_sql(str(seed), "b", "_pos", "_n")).alias("_idx")))


def _positioned(long: DataFrame, part: list[str], order: str, values: list[str], models, name: str) -> tuple[DataFrame, DataFrame]:
    """Rows of each (series, model) numbered 0..n-1, and the same as one row per (series, n, position) with a column
    ``<value>_<i>`` for model number i.  Written once, since draws and drawn rows both read them."""
    base = materialize(long.withColumns({"_pos": F.row_number().over(Window.partitionBy(*part, "model").orderBy(order)) - 1,
                                         "_n": F.count(F.lit(1)).over(Window.partitionBy(*part, "model"))}), name)
    wide = base.groupBy(*part, "_n", "_pos").agg(*[F.max(F.when(F.col("model") == m, F.col(v))).alias(f"{v}_{i}")
                                                   for i, m in enumerate(models) for v in values])
    return base, materialize(wide, f"{name}-wide")


def _percentile_ci(rep: DataFrame, part: list[str], value: str, alpha: float, *more) -> DataFrame:
    return rep.groupBy(*part).agg(F.percentile(value, F.lit(alpha / 2)).alias("ci_lo"),
                                  F.percentile(value, F.lit(1 - alpha / 2)).alias("ci_hi"), F.count(value).alias("n_boot"), *more)


def bootstrap_metric_ci(wide: DataFrame, models, metric, name: str = "value", y: str = "target_vol", n_boot: int = 2000,
                        alpha: float = 0.05, seed: int = 42, keys=("symbol",), order: str = "date") -> DataFrame:
    """K3 for any metric: percentile bootstrap CI per (symbol, model), on the rows that model has: (keys, model, ``name``,
    ci_lo, ci_hi, n_boot).

    ``metric``: (y_true, y_pred) columns -> an aggregate column, e.g. ``lambda y, p: F.avg(F.abs(p - y))``.  Replicate b draws n
    positions with replacement and joins back the rows drawn."""
    part, models = [*keys, "model"], list(models)
    long = wide.select(*keys, order, F.inline(F.array(*[
        F.struct(F.lit(m).alias("model"), F.col(y).cast("double").alias("_t"), F.col(m).cast("double").alias("_p")) for m in models])))
    base, rows = _positioned(long.where("_t IS NOT NULL AND _p IS NOT NULL"), list(keys), order, ["_t", "_p"], models, "bootstrap_base")
    drawn = _draws(rows, list(keys), n_boot, seed).join(rows.withColumnRenamed("_pos", "_idx"), [*keys, "_n", "_idx"])
    rep = drawn.groupBy(*keys, "_n", "b").agg(*[c for i in range(len(models)) for c in (
        metric(F.col(f"_t_{i}"), F.col(f"_p_{i}")).alias(f"_r{i}"), F.count(f"_t_{i}").alias(f"_c{i}"))])
    rep = rep.select(*keys, F.inline(F.array(*[F.struct(F.lit(m).alias("model"), F.when(F.col(f"_c{i}") > 0, F.col(f"_r{i}")).alias("_v"))
                                               for i, m in enumerate(models)])))
    point = base.groupBy(*part).agg(metric(F.col("_t"), F.col("_p")).alias(name))
    return point.join(_percentile_ci(rep.where("_v IS NOT NULL"), part, "_v", alpha), part)


def bootstrap_rmse_ci(wide: DataFrame, models, **options) -> DataFrame:
    """K3: percentile bootstrap CI of RMSE per (symbol, model)."""
    return bootstrap_metric_ci(wide, models, lambda y, p: F.sqrt(F.avg((p - y) * (p - y))), "rmse", **options)


#: Cumulative Poisson(1) probabilities P(X <= k), k = 0..15; beyond, less than 1e-13 is left.
POISSON_1 = [sum(math.exp(-1) / math.factorial(j) for j in range(k + 1)) for k in range(16)]


def poisson_weight_sql(u: str) -> str:
    """Poisson(1) variate of a uniform: how many cumulative probabilities it passes."""
    return "(" + " + ".join(f"CAST({u} >= {c!r} AS INT)" for c in POISSON_1) + ")"


def poisson_bootstrap_rmse_ci(wide: DataFrame, models, y: str = "target_vol", n_boot: int = 2000,
                              alpha: float = 0.05, seed: int = 42, keys=("symbol",), order: str = "date") -> DataFrame:
    """K3 without a join: every (row, replicate) carries a Poisson(1) weight, so a replicate is one partial
    aggregation and the shuffle holds tasks x replicates partial rows whatever the row count."""
    long = wide.select(*keys, order, F.inline(F.array(*[
        F.struct(F.lit(m).alias("model"), ((F.col(m) - F.col(y)) ** 2).alias("_e")) for m in models]))).where("_e IS NOT NULL")
    part = [*keys, "model"]
    drawn = (long.withColumn("_row", ntz_to_micros(F.col(order).cast("timestamp_ntz"))).select(*part, "_e", "_row", F.explode(F.sequence(F.lit(0), F.lit(n_boot - 1))).alias("b"))
             .withColumn("_u", F.expr(uniform_sql(str(seed), "b", "_row"))).withColumn("_w", F.expr(poisson_weight_sql("_u"))))
    rep = drawn.groupBy(*part, "b").agg(F.sqrt(F.try_divide(F.sum(F.col("_w") * F.col("_e")), F.sum("_w").cast("double"))).alias("rmse_b"))
    return long.groupBy(*part).agg(F.sqrt(F.avg("_e")).alias("rmse")).join(_percentile_ci(rep, part, "rmse_b", alpha), part)


def midranks(df: DataFrame, score: str, part: list[str], out: str) -> DataFrame:
    """K5: 1-based average rank over ties within ``part``."""
    w = Window.partitionBy(*part).orderBy(score)
    ties = F.count(F.lit(1)).over(Window.partitionBy(*part, score))
    return df.withColumn(out, F.rank().over(w) + (ties - 1) / 2.0)


def delong(wide: DataFrame, models, label: str = "target_regime", keys=("symbol",), order: str = "date") -> DataFrame:
    """K6-K7: DeLong test (fast structural components) for every model pair, on the rows both models have.

    With P and N the positives and negatives below a score, p and q those tied with it, a positive's component is V01 =
    (N + q / 2) / n and a negative's V10 = 1 - (P + p / 2) / m (the mid-rank forms).  Both counts are range windows in the
    partitioning by pair, so the rows are read once and nothing is joined back.  AUC = mean of V01;
    S = cov(V01)/m + cov(V10)/n (ddof 1); z = (AUC_a - AUC_b) / sqrt(S_aa + S_bb - 2 S_ab); NULL with one class, too
    few rows or var <= 0."""
    pair = [*keys, "model_a", "model_b"]
    rows = wide.where(F.col(label).isNotNull()).select(*keys, order, F.col(label).cast("int").alias("_y"), F.inline(F.array(*[
        F.struct(F.lit(a).alias("model_a"), F.lit(b).alias("model_b"), F.col(a).alias("_sa"), F.col(b).alias("_sb")) for a, b in _pairs(models)])))
    rows = rows.where("_sa IS NOT NULL AND _sb IS NOT NULL")
    whole = Window.partitionBy(*pair)
    pos, neg = F.col("_y"), 1 - F.col("_y")
    rows = rows.withColumns({"_m": F.sum(pos).over(whole).cast("double"), "_n": F.sum(neg).over(whole).cast("double")})
    for side in ("a", "b"):  # peers share a frame, so "up to" and "from" meet in the ties
        up, down = whole.orderBy(f"_s{side}"), whole.orderBy(F.desc(f"_s{side}"))
        below_p, below_n = F.col("_m") - F.sum(pos).over(down), F.col("_n") - F.sum(neg).over(down)
        rows = rows.withColumns({"_pb": below_p, "_nb": below_n, "_pu": F.sum(pos).over(up), "_nu": F.sum(neg).over(up)})
        v01 = F.try_divide(F.col("_nb") + (F.col("_nu") - F.col("_nb")) / 2.0, F.col("_n"))
        v10 = 1.0 - F.try_divide(F.col("_pb") + (F.col("_pu") - F.col("_pb")) / 2.0, F.col("_m"))
        rows = rows.withColumn(f"_{side}", F.when(F.col("_y") == 1, v01).otherwise(v10)).drop("_pb", "_nb", "_pu", "_nu")
    both = rows
    aggs = [F.first("_m").alias("m"), F.first("_n").alias("n")]
    for side in ("a", "b"):
        aggs.append(F.avg(F.when(F.col("_y") == 1, F.col(f"_{side}"))).alias(f"auc_{side}"))
    for y, n in ((1, "01"), (0, "10")):
        ca, cb = F.when(F.col("_y") == y, F.col("_a")), F.when(F.col("_y") == y, F.col("_b"))
        aggs += [F.covar_samp(ca, ca).alias(f"aa{n}"), F.covar_samp(cb, cb).alias(f"bb{n}"), F.covar_samp(ca, cb).alias(f"ab{n}")]
    agg = both.groupBy(*pair).agg(*aggs).where("m > 0 AND n > 0")
    s = lambda k: F.col(f"{k}01") / F.col("m") + F.col(f"{k}10") / F.col("n")
    agg = agg.withColumns({"_var": s("aa") + s("bb") - 2.0 * s("ab"), "auc_diff": F.col("auc_a") - F.col("auc_b")})
    long = agg.select(*pair, "auc_a", "auc_b", "auc_diff", F.when(F.col("_var") > 0, F.col("auc_diff") / F.sqrt("_var")).alias("statistic"))
    return long.withColumn("p_value", F.expr(normal_two_sided_p_sql("statistic")))


def bootstrap_auc_ci(wide: DataFrame, models, label: str = "target_regime", n_boot: int = 2000,
                     alpha: float = 0.05, seed: int = 42, keys=("symbol",), order: str = "date") -> DataFrame:
    """K4: percentile bootstrap CI of ROC AUC per (symbol, model), on the rows that model has.

    Same hash-drawn index table as K3; a replicate's AUC is the exact
    Mann-Whitney AUC with the draw multiplicities as weights.  Replicates
    holding one class only are undefined: dropped and counted (T7)."""
    part = [*keys, "model"]
    long = wide.where(F.col(label).isNotNull()).select(*keys, order, F.col(label).cast("int").alias("_y"), F.inline(F.array(*[
        F.struct(F.lit(m).alias("model"), F.col(m).alias("score")) for m in models]))).where("score IS NOT NULL")
    models = list(models)
    _, rows = _positioned(long, list(keys), order, ["_y", "score"], models, "bootstrap_auc_base")
    # Multiplicity of every drawn row per replicate, then one row per (replicate, score) of each model.
    mult = _draws(rows, list(keys), n_boot, seed).groupBy(*keys, "_n", "b", "_idx").agg(F.count(F.lit(1)).alias("_w"))
    each = mult.join(rows.withColumnRenamed("_pos", "_idx"), [*keys, "_n", "_idx"]).select(*keys, "b", "_w", F.inline(F.array(*[
        F.struct(F.lit(m).alias("model"), F.col(f"_y_{i}").alias("_y"), F.col(f"score_{i}").alias("score")) for i, m in enumerate(models)])))
    c = each.where("score IS NOT NULL").groupBy(*part, "b", "score").agg(
        F.sum(F.when(F.col("_y") == 1, F.col("_w")).otherwise(0)).alias("pos"),
        F.sum(F.when(F.col("_y") == 0, F.col("_w")).otherwise(0)).alias("neg"))
    wc = Window.partitionBy(*part, "b").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    c = c.withColumn("_nb", F.coalesce(F.sum("neg").over(wc), F.lit(0)))
    rep = c.groupBy(*part, "b").agg(
        F.sum(F.col("pos") * (F.col("_nb") + 0.5 * F.col("neg"))).alias("_u"),
        F.sum("pos").alias("_p"), F.sum("neg").alias("_q"))
    rep = rep.withColumn("auc_b", F.when((F.col("_p") > 0) & (F.col("_q") > 0),
                                         F.col("_u") / (F.col("_p") * F.col("_q")).cast("double")))
    return _percentile_ci(rep, part, "auc_b", alpha, F.count_if(F.col("auc_b").isNull()).alias("n_undefined"))
