"""Registered queries: name -> (Spark builder, DuckDB oracle SQL or None).

Every builder reads the driver's tables from ``sf_dir`` (whole tables) and
returns a DataFrame whose double columns are rounded exactly like the
oracle's, so the driver's order-insensitive value hash can compare them."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ripplet.functions.expr import round_doubles
from ripplet.plans import oracle_sql as O
from ripplet.plans.panel import daily_panel, hourly_panel
from ripplet.sources.bars import daily_bars_from_lineitem, hourly_bars_from_events
from ripplet.sources.tables import read_table

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}

SIX = dict(O.DIGITS)


def register(name: str, sql: str | None):
    def deco(fn: Builder) -> Builder:
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def _r(df: DataFrame, overrides: dict[str, int] | None = None) -> DataFrame:
    return round_doubles(df, 8, {**SIX, **(overrides or {})})


BAR_COLS = [("symbol", "k"), ("date", "k"), ("open", "d"), ("high", "d"), ("low", "d"),
            ("close", "d"), ("volume", "d")]

# ---------------------------------------------------------------- A8 bars
register("bars_daily", f"""
WITH b AS ({O.daily_bars_sql()})
SELECT {O.select_rounded(BAR_COLS, SIX)} FROM b""")(
    lambda spark, d: _r(daily_bars_from_lineitem(spark, d)))

register("bars_hourly", f"""
WITH b AS ({O.hourly_bars_sql()})
SELECT {O.select_rounded(BAR_COLS, SIX)} FROM b""")(
    lambda spark, d: _r(hourly_bars_from_events(spark, d)))

# ---------------------------------------------------------------- C, D: panel
PANEL_COLS = (BAR_COLS + [("log_return", "d"), ("vol_realized", "d")]
              + [(c, "k" if c in ("dow", "month") else "d") for c in O.FEATURES]
              + [("target_vol", "d"), ("regime_threshold", "d"), ("target_regime", "k"), ("split", "k")])


def _panel_sql(bars_sql: str) -> str:
    return f"WITH {O.panel_ctes(bars_sql)}\nSELECT {O.select_rounded(PANEL_COLS, SIX)} FROM panel"


register("panel_daily", _panel_sql(O.daily_bars_sql()))(
    lambda spark, d: _r(daily_panel(spark, d).select(*[c for c, _ in PANEL_COLS])))
register("panel_hourly", _panel_sql(O.hourly_bars_sql()))(
    lambda spark, d: _r(hourly_panel(spark, d).select(*[c for c, _ in PANEL_COLS])))

# ---------------------------------------------------------------- E forecasters, I metrics
from ripplet.operators import forecast as FC  # noqa: E402
from ripplet.functions import ranks as RK  # noqa: E402
from ripplet.operators import metrics as M  # noqa: E402

_DAILY_PREDS = O.with_preds(O.daily_bars_sql())


def daily_preds(spark: SparkSession, d: str) -> DataFrame:
    return FC.all_benchmarks(daily_panel(spark, d))


register("forecasts", f"""{_DAILY_PREDS}
SELECT symbol, date, split, model, {O.sql_rnd('y_true')} AS y_true, {O.sql_rnd('y_pred')} AS y_pred FROM preds""")(
    lambda spark, d: _r(daily_preds(spark, d)))

register("forecast_summary", f"""{_DAILY_PREDS}
SELECT symbol, split, model, {O.sql_rnd('sqrt(avg((y_pred - y_true) * (y_pred - y_true)))')} AS rmse,
       {O.sql_rnd('avg(abs(y_pred - y_true))')} AS mae, count(*) AS n_valid
FROM preds WHERE y_pred IS NOT NULL AND y_true IS NOT NULL GROUP BY symbol, split, model""")(
    lambda spark, d: _r(FC.summarize(daily_preds(spark, d))))

register("cum_abs_error", f"""{_DAILY_PREDS}
SELECT symbol, split, model, date,
       {O.sql_rnd('sum(coalesce(abs(y_pred - y_true), 0.0)) OVER (PARTITION BY symbol, split, model ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)', 6)} AS cum_abs_error
FROM preds""")(
    lambda spark, d: round_doubles(FC.cumulative_abs_error(daily_preds(spark, d)), 6))

register("regression_metrics", f"""{_DAILY_PREDS}
SELECT symbol, model, split, {O.sql_rnd('sqrt(avg((y_pred - y_true) * (y_pred - y_true)))')} AS rmse,
       {O.sql_rnd('avg(abs(y_pred - y_true))')} AS mae,
       {O.sql_rnd('1.0 - sum((y_pred - y_true) * (y_pred - y_true)) / (var_pop(y_true) * count(*))', 6)} AS r2,
       count(*) AS n
FROM preds WHERE y_pred IS NOT NULL AND y_true IS NOT NULL GROUP BY symbol, model, split""")(
    lambda spark, d: _r(M.regression_metrics(daily_preds(spark, d)), {"r2": 6}))

FLAGSHIP = "forecast_summary"

# ---------------------------------------------------------------- B exploration
from ripplet.operators import explore as X  # noqa: E402
from ripplet.operators.features import FEATURE_COLUMNS, build_features  # noqa: E402
from ripplet.operators.splits import split_summary  # noqa: E402
from ripplet.plans.panel import targets_table  # noqa: E402

_NULL_COLS = FEATURE_COLUMNS + ["target_vol", "target_regime"]
_PANEL = f"WITH {O.panel_ctes(O.daily_bars_sql())}"

register("null_counts", _PANEL + "\n" + " UNION ALL ".join(
    f"SELECT symbol, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS n_null FROM t2 GROUP BY symbol"
    for c in _NULL_COLS))(
    lambda spark, d: X.null_counts(targets_table(daily_bars_from_lineitem(spark, d)), _NULL_COLS))

_DESC_COLS = [("symbol", "k"), ("count", "k")] + [(c, "d") for c in ("mean", "std", "min", "q25", "q50", "q75", "max")]
register("calendar_gaps", f"""WITH bars AS ({O.daily_bars_sql()}),
g AS (SELECT symbol, CAST(date - lag(date) OVER (PARTITION BY symbol ORDER BY date) AS DOUBLE) AS gap_days FROM bars)
SELECT {O.select_rounded(_DESC_COLS)} FROM (
  SELECT symbol, {O.describe_sql('gap_days')} FROM g WHERE gap_days IS NOT NULL GROUP BY symbol)""")(
    lambda spark, d: _r(X.calendar_gaps(daily_bars_from_lineitem(spark, d))))

register("ohlc_coherence", f"""WITH bars AS ({O.daily_bars_sql()})
SELECT symbol, count(*) AS n_bars, count(*) FILTER (WHERE high < greatest(open, close)) AS n_high_below,
       count(*) FILTER (WHERE low > least(open, close)) AS n_low_above FROM bars GROUP BY symbol""")(
    lambda spark, d: X.ohlc_coherence(daily_bars_from_lineitem(spark, d)))

_MOM_COLS = [("symbol", "k"), ("count", "k"), ("mean", "d"), ("std", "d"), ("min", "d"), ("q25", "d"),
             ("q50", "d"), ("q75", "d"), ("max", "d"), ("skew", "d"), ("kurt", "d")]
register("return_moments", f"""{_PANEL},
m AS (SELECT symbol, {O.describe_sql('log_return')}, skewness(log_return) AS skew, kurtosis(log_return) AS kurt
      FROM panel WHERE log_return IS NOT NULL GROUP BY symbol)
SELECT {O.select_rounded(_MOM_COLS, {'skew': 6, 'kurt': 6})} FROM m""")(
    lambda spark, d: _r(X.return_moments(daily_panel(spark, d)), {"skew": 6, "kurt": 6}))

register("histogram_returns", f"""{_PANEL},
b AS (SELECT symbol, log_return AS x, min(log_return) OVER (PARTITION BY symbol) AS lo,
             max(log_return) OVER (PARTITION BY symbol) AS hi FROM panel WHERE log_return IS NOT NULL),
h AS (SELECT symbol, CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((x - lo) / (hi - lo) * 120.0), 119) END AS INTEGER) AS bin,
             count(*) AS n, any_value(lo) AS lo, any_value(hi) AS hi FROM b GROUP BY ALL)
SELECT symbol, bin, {O.sql_rnd('lo + bin * ((hi - lo) / 120.0)')} AS edge_lo,
       {O.sql_rnd('lo + (bin + 1) * ((hi - lo) / 120.0)')} AS edge_hi, n FROM h""")(
    lambda spark, d: _r(X.histogram(daily_panel(spark, d), "log_return", 120)))


def _acf_both(spark, d):
    p = daily_panel(spark, d).withColumn("r2", F.col("log_return") * F.col("log_return"))
    a = X.acf(p, "log_return", 40).withColumn("series", F.lit("r"))
    b = X.acf(p, "r2", 40).withColumn("series", F.lit("r2"))
    return _r(a.unionByName(b))


register("acf_returns", f"""{_PANEL},{O.acf_sql('panel', 'log_return', 'r', 40)},{O.acf_sql('panel', 'log_return * log_return', 'r2', 40)}
SELECT symbol, series, lag, {O.sql_rnd('acf')} AS acf, {O.sql_rnd('band')} AS band FROM (SELECT * FROM acf_r UNION ALL SELECT * FROM acf_r2)""")(
    _acf_both)

register("split_summary", f"""{_PANEL}
SELECT symbol, split, count(*) AS n_rows, min(date) AS date_min, max(date) AS date_max FROM panel GROUP BY symbol, split""")(
    lambda spark, d: split_summary(daily_panel(spark, d)))

register("class_balance", f"""{_PANEL}
SELECT symbol, split, count(*) AS n, count(*) FILTER (WHERE target_regime = 1) AS n_pos,
       count(*) FILTER (WHERE target_regime = 0) AS n_neg, {O.sql_rnd('avg(CAST(target_regime AS DOUBLE))')} AS p_pos
FROM panel WHERE target_regime IS NOT NULL GROUP BY symbol, split""")(
    lambda spark, d: _r(X.class_balance(daily_panel(spark, d))))

_SHIFT_Q = (0.1, 0.25, 0.5, 0.75, 0.9)
register("target_shift", f"""{_PANEL}
SELECT symbol, split, count(target_vol) AS n, {O.sql_rnd('avg(target_vol)')} AS mean,
       {O.sql_rnd('stddev_samp(target_vol)')} AS std,
       {", ".join(f"{O.sql_rnd(f'quantile_cont(target_vol, {q})')} AS q{int(round(q * 100))}" for q in _SHIFT_Q)}
FROM panel WHERE target_vol IS NOT NULL GROUP BY symbol, split""")(
    lambda spark, d: _r(X.target_shift(daily_panel(spark, d))))

# ---------------------------------------------------------------- I2-I6 classification + leaderboard
_CLS = _DAILY_PREDS + O.cls_cte()


def daily_cls(spark: SparkSession, d: str) -> DataFrame:
    return M.regime_scores_wide(FC.add_forecasts(daily_panel(spark, d)), FC.MODELS)


register("classification_metrics", f"""{_CLS}
SELECT symbol, model, split, {O.sql_rnd('avg(CAST(label = pred AS DOUBLE))')} AS accuracy,
  {O.sql_rnd("coalesce(count(*) FILTER (WHERE label = 1 AND pred = 1) / NULLIF(CAST(count(*) FILTER (WHERE pred = 1) AS DOUBLE), 0), 0.0)")} AS precision,
  {O.sql_rnd("coalesce(count(*) FILTER (WHERE label = 1 AND pred = 1) / NULLIF(CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE), 0), 0.0)")} AS recall,
  {O.sql_rnd("coalesce(2.0 * count(*) FILTER (WHERE label = 1 AND pred = 1) / NULLIF(CAST(count(*) FILTER (WHERE pred = 1) + count(*) FILTER (WHERE label = 1) AS DOUBLE), 0), 0.0)")} AS f1,
  count(*) AS n
FROM cls WHERE label IS NOT NULL AND pred IS NOT NULL GROUP BY symbol, model, split""")(
    lambda spark, d: _r(M.classification_metrics(daily_cls(spark, d))))

_SC = """,
    sc AS (SELECT symbol, model, split, score, CAST(sum(label) AS BIGINT) AS pos, CAST(sum(1 - label) AS BIGINT) AS neg
           FROM cls WHERE label IS NOT NULL AND score IS NOT NULL GROUP BY symbol, model, split, score)"""

register("roc_auc", f"""{_CLS}{_SC},
sc2 AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY symbol, model, split ORDER BY score
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb FROM sc)
SELECT symbol, model, split,
       {O.sql_rnd('sum(pos * (nb + 0.5 * neg)) / NULLIF(CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE), 0)')} AS auc,
       CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg
FROM sc2 GROUP BY symbol, model, split""")(
    lambda spark, d: _r(M.roc_auc(daily_cls(spark, d))))

# all symbols in one group: ranks by value buckets and prefix sums, no window over a whole group
register("roc_auc_pooled", f"""{_CLS}{_SC},
po AS (SELECT model, split, score, sum(pos) AS pos, sum(neg) AS neg FROM sc GROUP BY ALL),
sc2 AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY model, split ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb FROM po)
SELECT model, split, {O.sql_rnd('sum(pos * (nb + 0.5 * neg)) / NULLIF(CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE), 0)')} AS auc,
       CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg
FROM sc2 GROUP BY model, split""")(
    lambda spark, d: _r(RK.pooled_roc_auc(daily_cls(spark, d), ("model", "split"))))

register("midranks_pooled", f"""{_CLS}{_SC},
po AS (SELECT model, score, CAST(sum(pos + neg) AS BIGINT) AS n FROM sc GROUP BY ALL)
SELECT model, {O.sql_rnd('score')} AS score, n,
       coalesce(sum(n) OVER (PARTITION BY model ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + (n + 1) / 2.0 AS midrank FROM po""")(
    lambda spark, d: _r(RK.pooled_midranks(daily_cls(spark, d).where("label IS NOT NULL AND score IS NOT NULL"), "score", ("model",))))

register("roc_curve", f"""{_CLS}{_SC}
SELECT symbol, model, split, {O.sql_rnd('score')} AS threshold,
  {O.sql_rnd('sum(neg) OVER (PARTITION BY symbol, model, split ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / NULLIF(CAST(sum(neg) OVER (PARTITION BY symbol, model, split) AS DOUBLE), 0)')} AS fpr,
  {O.sql_rnd('sum(pos) OVER (PARTITION BY symbol, model, split ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / NULLIF(CAST(sum(pos) OVER (PARTITION BY symbol, model, split) AS DOUBLE), 0)')} AS tpr
FROM sc""")(
    lambda spark, d: _r(M.roc_curve(daily_cls(spark, d))))

register("confusion_matrix", f"""{_CLS}
SELECT symbol, model, split, label AS y_true, pred AS y_pred, count(*) AS n
FROM cls WHERE label IS NOT NULL AND pred IS NOT NULL GROUP BY ALL""")(
    lambda spark, d: M.confusion_matrix(daily_cls(spark, d)))

_RM = """,
    rm AS (SELECT symbol, model, split, sqrt(avg((y_pred - y_true) * (y_pred - y_true))) AS rmse
           FROM preds WHERE y_pred IS NOT NULL AND y_true IS NOT NULL GROUP BY symbol, model, split)"""

register("leaderboard", f"""{_DAILY_PREDS}{_RM}
SELECT symbol, split, model, {O.sql_rnd('rmse')} AS rmse,
       row_number() OVER (PARTITION BY symbol, split ORDER BY rmse, model) AS rank FROM rm""")(
    lambda spark, d: _r(M.leaderboard(FC.summarize(daily_preds(spark, d), ("symbol", "model", "split"))
                                      .select("symbol", "split", "model", "rmse"))))

register("val_test_gap", f"""{_DAILY_PREDS}{_RM}
SELECT symbol, model, {O.sql_rnd("max(rmse) FILTER (WHERE split = 'val')")} AS rmse_val,
       {O.sql_rnd("max(rmse) FILTER (WHERE split = 'test')")} AS rmse_test,
       {O.sql_rnd("max(rmse) FILTER (WHERE split = 'test') - max(rmse) FILTER (WHERE split = 'val')")} AS gap
FROM rm GROUP BY symbol, model""")(
    lambda spark, d: _r(M.val_test_gap(FC.summarize(daily_preds(spark, d), ("symbol", "model", "split")))))

# ---------------------------------------------------------------- J residual diagnostics
from ripplet.functions.random import index_sql, uniform_sql  # noqa: E402
from ripplet.functions.special import chi2_sf_sql, normal_two_sided_p_sql  # noqa: E402
from ripplet.operators import compare as K  # noqa: E402
from ripplet.operators import residuals as J  # noqa: E402

_RES = _DAILY_PREDS + O.residual_ctes()
_STAT6 = {"statistic": 6}

register("residual_tests", f"""{_RES}
SELECT symbol, model, test, {O.sql_rnd('statistic', 6)} AS statistic, {O.sql_rnd('p_value')} AS p_value
FROM ({O.residual_tests_select()})""")(
    lambda spark, d: _r(J.residual_tests(daily_preds(spark, d)), _STAT6))

_SUM_COLS = ([("symbol", "k"), ("model", "k"), ("n", "k")]
             + [(c, "d") for c in ("mean", "std", "min", "max", "skew", "kurtosis", "white_stat", "white_p",
                                   "bp_stat", "bp_p", "ljung_box_stat", "ljung_box_p", "jb_stat", "jb_p")])
_SUM_DIG = {c: 6 for c in ("skew", "kurtosis", "white_stat", "bp_stat", "ljung_box_stat", "jb_stat")}
register("residual_summary", f"""{_RES}
SELECT {O.select_rounded(_SUM_COLS, _SUM_DIG)} FROM (
  SELECT symbol, model, n, mean, std, min, max, skew_pop AS skew, kurt_pop AS kurtosis,
         white AS white_stat, {chi2_sf_sql('white', 2)} AS white_p, bp AS bp_stat, {chi2_sf_sql('bp', 1)} AS bp_p,
         lb AS ljung_box_stat, {chi2_sf_sql('lb', 10)} AS ljung_box_p, jb AS jb_stat, {chi2_sf_sql('jb', 2)} AS jb_p
  FROM rst2)""")(
    lambda spark, d: _r(J.residual_summary(daily_preds(spark, d)), _SUM_DIG))


def _res_acf_sql(n_lags: int = 30) -> str:
    P = "PARTITION BY symbol, model"
    lags = ", ".join(f"lag(d, {k}) OVER ({P} ORDER BY date) AS l{k}" for k in range(1, n_lags + 1))
    sums = ", ".join(f"sum(d * l{k}) AS g{k}" for k in range(1, n_lags + 1))
    unions = " UNION ALL ".join(
        f"SELECT symbol, model, {k} AS lag, g{k} / g0 AS acf, 1.96 / sqrt(CAST(n AS DOUBLE)) AS band FROM ra"
        for k in range(1, n_lags + 1))
    return f"""{_RES},
    rla AS (SELECT symbol, model, d, {lags} FROM rd),
    ra AS (SELECT symbol, model, count(*) AS n, sum(d * d) AS g0, {sums} FROM rla GROUP BY symbol, model)
    SELECT symbol, model, lag, {O.sql_rnd('acf')} AS acf, {O.sql_rnd('band')} AS band FROM ({unions})"""


register("residual_acf", _res_acf_sql())(lambda spark, d: _r(J.residual_acf(daily_preds(spark, d))))

# ---------------------------------------------------------------- K forecast comparison
MODELS = sorted(FC.MODELS)


def daily_wide_test(spark: SparkSession, d: str) -> DataFrame:
    return FC.add_forecasts(daily_panel(spark, d)).where(F.col("split") == "test")


_DM_COLS = [("symbol", "k"), ("model_a", "k"), ("model_b", "k"), ("n", "k"), ("mean_loss_diff", "d"),
            ("statistic", "d"), ("p_value", "d"), ("horizon", "k"), ("n_pairs", "k"), ("alpha_bonferroni", "d"),
            ("significant_5pct", "k"), ("significant_bonferroni", "k")]
register("dm_pairs", f"""{_DAILY_PREDS},
dmd AS (SELECT a.symbol, a.model AS model_a, b.model AS model_b,
               (a.y_pred - a.y_true) * (a.y_pred - a.y_true) - (b.y_pred - b.y_true) * (b.y_pred - b.y_true) AS d
        FROM preds a JOIN preds b ON a.symbol = b.symbol AND a.date = b.date AND a.model < b.model
        WHERE a.split = 'test' AND a.y_true IS NOT NULL AND a.y_pred IS NOT NULL AND b.y_pred IS NOT NULL),
dma AS (SELECT symbol, model_a, model_b, count(*) AS n, avg(d) AS mean_loss_diff,
               CASE WHEN var_pop(d) > 0 THEN avg(d) / sqrt(var_pop(d) / count(*)) END AS statistic
        FROM dmd GROUP BY ALL),
dmp AS (SELECT *, {normal_two_sided_p_sql('statistic')} AS p_value, 1 AS horizon,
               count(*) OVER (PARTITION BY symbol) AS n_pairs FROM dma)
SELECT {O.select_rounded(_DM_COLS, {'statistic': 6})} FROM (
  SELECT *, 0.05 / n_pairs AS alpha_bonferroni, p_value < 0.05 AS significant_5pct,
         p_value < 0.05 / n_pairs AS significant_bonferroni FROM dmp)""")(
    lambda spark, d: _r(K.bonferroni(K.diebold_mariano(daily_wide_test(spark, d), MODELS)), {"statistic": 6}))

_DM_PAIRS = """dmd AS (SELECT a.symbol, a.model AS model_a, b.model AS model_b, a.date, {loss} AS d
        FROM preds a JOIN preds b ON a.symbol = b.symbol AND a.date = b.date AND a.model < b.model
        WHERE a.split = 'test' AND a.y_true IS NOT NULL AND a.y_pred IS NOT NULL AND b.y_pred IS NOT NULL)"""
_SE = "(a.y_pred - a.y_true) * (a.y_pred - a.y_true) - (b.y_pred - b.y_true) * (b.y_pred - b.y_true)"
_AE = "abs(a.y_pred - a.y_true) - abs(b.y_pred - b.y_true)"


def _dm_sql(loss: str, horizon: int) -> str:
    lags = range(1, horizon)
    cols = "".join(f", lag(c, {k}) OVER (PARTITION BY symbol, model_a, model_b ORDER BY date) AS c{k}" for k in lags)
    var = "var_pop(d)" + "".join(f" + 2.0 * coalesce(avg(c * c{k}), 0.0)" for k in lags)
    return f"""{_DAILY_PREDS},
{_DM_PAIRS.format(loss=loss)},
dmc AS (SELECT *, d - avg(d) OVER (PARTITION BY symbol, model_a, model_b) AS c FROM dmd),
dml AS (SELECT *{cols} FROM dmc),
dma AS (SELECT symbol, model_a, model_b, count(*) AS n, avg(d) AS mean_loss_diff,
               CASE WHEN {var} > 0 THEN avg(d) / sqrt(({var}) / count(*)) END AS statistic FROM dml GROUP BY ALL),
dmp AS (SELECT *, {normal_two_sided_p_sql('statistic')} AS p_value, {horizon} AS horizon,
               count(*) OVER (PARTITION BY symbol) AS n_pairs FROM dma)
SELECT {O.select_rounded(_DM_COLS, {'statistic': 6})} FROM (
  SELECT *, 0.05 / n_pairs AS alpha_bonferroni, p_value < 0.05 AS significant_5pct,
         p_value < 0.05 / n_pairs AS significant_bonferroni FROM dmp)"""


register("dm_pairs_ae", _dm_sql(_AE, 1))(
    lambda spark, d: _r(K.bonferroni(K.diebold_mariano(daily_wide_test(spark, d), MODELS, loss="ae")), {"statistic": 6}))
register("dm_pairs_h5", _dm_sql(_SE, 5))(
    lambda spark, d: _r(K.bonferroni(K.diebold_mariano(daily_wide_test(spark, d), MODELS, horizon=5)), {"statistic": 6}))

register("bootstrap_rmse_ci_poisson", f"""{_DAILY_PREDS},
bt AS (SELECT symbol, model, (y_pred - y_true) * (y_pred - y_true) AS e2, epoch_us(CAST(date AS TIMESTAMP)) AS id
       FROM preds WHERE split = 'test' AND y_true IS NOT NULL AND y_pred IS NOT NULL),
dr AS (SELECT symbol, model, e2, r.b, {uniform_sql('42', 'r.b', 'id', 'duckdb')} AS u FROM bt CROSS JOIN range(0, 500) r(b)),
wt AS (SELECT *, {K.poisson_weight_sql('u')} AS w FROM dr),
rep AS (SELECT symbol, model, b, sqrt(sum(w * e2) / sum(w)) AS rmse_b FROM wt GROUP BY ALL),
ci AS (SELECT symbol, model, quantile_cont(rmse_b, 0.025) AS ci_lo, quantile_cont(rmse_b, 0.975) AS ci_hi, count(*) AS n_boot FROM rep GROUP BY ALL),
pt AS (SELECT symbol, model, sqrt(avg(e2)) AS rmse FROM bt GROUP BY ALL)
SELECT symbol, model, {O.sql_rnd('rmse')} AS rmse, {O.sql_rnd('ci_lo')} AS ci_lo, {O.sql_rnd('ci_hi')} AS ci_hi, n_boot
FROM pt JOIN ci USING (symbol, model)""")(
    lambda spark, d: _r(K.poisson_bootstrap_rmse_ci(daily_wide_test(spark, d), MODELS, n_boot=500)))

_B = 2000
register("bootstrap_rmse_ci", f"""{_DAILY_PREDS},
bt AS (SELECT symbol, model, (y_pred - y_true) * (y_pred - y_true) AS e2,
              row_number() OVER (PARTITION BY symbol, model ORDER BY date) - 1 AS pos,
              count(*) OVER (PARTITION BY symbol, model) AS n
       FROM preds WHERE split = 'test' AND y_true IS NOT NULL AND y_pred IS NOT NULL),
dr AS (SELECT symbol, model, r.b, {index_sql('42', 'r.b', 'pos', 'n', 'duckdb')} AS idx
       FROM bt CROSS JOIN range(0, {_B}) r(b)),
rep AS (SELECT dr.symbol, dr.model, dr.b, sqrt(avg(bt.e2)) AS rmse_b
        FROM dr JOIN bt ON dr.symbol = bt.symbol AND dr.model = bt.model AND dr.idx = bt.pos GROUP BY ALL),
ci AS (SELECT symbol, model, quantile_cont(rmse_b, 0.025) AS ci_lo, quantile_cont(rmse_b, 0.975) AS ci_hi,
              count(*) AS n_boot FROM rep GROUP BY ALL),
pt AS (SELECT symbol, model, sqrt(avg(e2)) AS rmse FROM bt GROUP BY ALL)
SELECT symbol, model, {O.sql_rnd('rmse')} AS rmse, {O.sql_rnd('ci_lo')} AS ci_lo, {O.sql_rnd('ci_hi')} AS ci_hi, n_boot
FROM pt JOIN ci USING (symbol, model)""")(
    lambda spark, d: _r(K.bootstrap_rmse_ci(daily_wide_test(spark, d), MODELS, n_boot=_B)))

register("bootstrap_mae_ci", REGISTRY["bootstrap_rmse_ci"][1].replace("(y_pred - y_true) * (y_pred - y_true) AS e2", "abs(y_pred - y_true) AS e2")
         .replace("sqrt(avg(bt.e2))", "avg(bt.e2)").replace("sqrt(avg(e2))", "avg(e2)").replace("rmse", "mae"))(
    lambda spark, d: _r(K.bootstrap_metric_ci(daily_wide_test(spark, d), MODELS, lambda y, p: F.avg(F.abs(p - y)), "mae", n_boot=_B)))

register("midranks", f"""{_DAILY_PREDS}
SELECT symbol, model, date, rank() OVER (PARTITION BY symbol, model ORDER BY y_pred)
       + (count(*) OVER (PARTITION BY symbol, model, y_pred) - 1) / 2.0 AS midrank
FROM preds WHERE split = 'test' AND y_pred IS NOT NULL""")(
    lambda spark, d: K.midranks(daily_preds(spark, d).where((F.col("split") == "test") & F.col("y_pred").isNotNull()),
                                "y_pred", ["symbol", "model"], "midrank").select("symbol", "model", "date", "midrank"))

_DL_COLS = [("symbol", "k"), ("model_a", "k"), ("model_b", "k"), ("auc_a", "d"), ("auc_b", "d"),
            ("auc_diff", "d"), ("statistic", "d"), ("p_value", "d"), ("n_pairs", "k"), ("alpha_bonferroni", "d"),
            ("significant_5pct", "k"), ("significant_bonferroni", "k")]
register("delong_pairs", f"""{_CLS},
dl AS (SELECT symbol, date, model, score AS s, label AS y FROM cls
       WHERE split = 'test' AND score IS NOT NULL AND label IS NOT NULL),
rk AS (SELECT *, rank() OVER (PARTITION BY symbol, model ORDER BY s)
                 + (count(*) OVER (PARTITION BY symbol, model, s) - 1) / 2.0 AS rz,
                 rank() OVER (PARTITION BY symbol, model, y ORDER BY s)
                 + (count(*) OVER (PARTITION BY symbol, model, y, s) - 1) / 2.0 AS rc,
                 CAST(sum(y) OVER (PARTITION BY symbol, model) AS DOUBLE) AS m,
                 CAST(sum(1 - y) OVER (PARTITION BY symbol, model) AS DOUBLE) AS n FROM dl),
v AS (SELECT *, CASE WHEN y = 1 THEN (rz - rc) / n END AS v01, CASE WHEN y = 0 THEN 1.0 - (rz - rc) / m END AS v10 FROM rk),
au AS (SELECT symbol, model, sum(CASE WHEN y = 1 THEN rz END) / (any_value(m) * any_value(n))
              - (any_value(m) + 1.0) / (2.0 * any_value(n)) AS auc, any_value(m) AS m, any_value(n) AS n,
              var_samp(v01) AS s01, var_samp(v10) AS s10 FROM v GROUP BY symbol, model),
pr AS (SELECT a.symbol, a.model AS model_a, b.model AS model_b,
              covar_samp(a.v01, b.v01) AS c01, covar_samp(a.v10, b.v10) AS c10
       FROM v a JOIN v b ON a.symbol = b.symbol AND a.date = b.date AND a.model < b.model GROUP BY ALL),
dz AS (SELECT pr.symbol, model_a, model_b, xa.auc AS auc_a, xb.auc AS auc_b, xa.auc - xb.auc AS auc_diff,
              (xa.s01 / xa.m + xa.s10 / xa.n) + (xb.s01 / xb.m + xb.s10 / xb.n) - 2.0 * (c01 / xa.m + c10 / xa.n) AS var
       FROM pr JOIN au xa ON xa.symbol = pr.symbol AND xa.model = pr.model_a
               JOIN au xb ON xb.symbol = pr.symbol AND xb.model = pr.model_b
       WHERE xa.m > 0 AND xa.n > 0),
dzz AS (SELECT *, CASE WHEN var > 0 THEN auc_diff / sqrt(var) END AS statistic FROM dz),
dzp AS (SELECT *, {normal_two_sided_p_sql('statistic')} AS p_value, count(*) OVER (PARTITION BY symbol) AS n_pairs FROM dzz)
SELECT {O.select_rounded(_DL_COLS, {'statistic': 6})} FROM (
  SELECT *, 0.05 / n_pairs AS alpha_bonferroni, p_value < 0.05 AS significant_5pct,
         p_value < 0.05 / n_pairs AS significant_bonferroni FROM dzp)""")(
    lambda spark, d: _r(K.bonferroni(K.delong(daily_wide_test(spark, d), MODELS)), {"statistic": 6}))

# ---------------------------------------------------------------- D6 folds, G balancing, F1/F2, F11
from ripplet.operators import balance as G  # noqa: E402
from ripplet.operators import naive_bayes as NB  # noqa: E402
from ripplet.operators import preprocess as PP  # noqa: E402
from ripplet.operators.splits import temporal_split, time_series_folds  # noqa: E402
from ripplet.functions.random import hash60_sql  # noqa: E402

register("cv_folds", f"""{_PANEL},
tr AS (SELECT symbol, date, row_number() OVER (PARTITION BY symbol ORDER BY date) - 1 AS pos,
              count(*) OVER (PARTITION BY symbol) AS n FROM panel WHERE split = 'train'),
fo AS (SELECT tr.*, f.fold, floor(n / 4) AS ts FROM tr CROSS JOIN range(0, 3) f(fold)),
ro AS (SELECT symbol, date, pos, fold,
              CASE WHEN pos >= n - (3 - fold) * ts AND pos < n - (3 - fold) * ts + ts THEN 'test'
                   WHEN pos < n - (3 - fold) * ts THEN 'train' END AS role FROM fo)
SELECT symbol, date, CAST(pos AS INTEGER) AS pos, CAST(fold AS INTEGER) AS fold, role FROM ro WHERE role IS NOT NULL""")(
    lambda spark, d: time_series_folds(daily_panel(spark, d).where(F.col("split") == "train").drop("split"),
                                       n_splits=3).select("symbol", "date", F.col("pos").cast("int").alias("pos"),
                                                          F.col("fold").cast("int").alias("fold"), "role"))


def _train_labels(spark, d):
    return daily_panel(spark, d).where(F.col("split") == "train").withColumnRenamed("target_regime", "label")


register("class_weights", f"""{_PANEL}
SELECT symbol, class, n_c, {O.sql_rnd('CAST(sum(n_c) OVER (PARTITION BY symbol) AS DOUBLE) / (2.0 * n_c)')} AS weight
FROM (SELECT symbol, target_regime AS class, count(*) AS n_c FROM panel WHERE split = 'train' GROUP BY ALL)""")(
    lambda spark, d: _r(G.class_weights(_train_labels(spark, d))))

register("scale_pos_weight", f"""{_PANEL}
SELECT symbol, n_pos, n_neg, {O.sql_rnd('CAST(n_neg AS DOUBLE) / greatest(n_pos, 1)')} AS scale_pos_weight
FROM (SELECT symbol, count(*) FILTER (WHERE target_regime = 1) AS n_pos, count(*) FILTER (WHERE target_regime = 0) AS n_neg
      FROM panel WHERE split = 'train' GROUP BY symbol)""")(
    lambda spark, d: _r(G.scale_pos_weight(_train_labels(spark, d))))

register("undersample_10pct", f"""{_PANEL},
u AS (SELECT symbol, date, target_regime AS label,
             {hash60_sql('42', "(date - DATE '1970-01-01')", '0', 'duckdb')} AS h,
             count(*) FILTER (WHERE target_regime = 0) OVER (PARTITION BY symbol) AS n0
      FROM panel WHERE split = 'train'),
r AS (SELECT *, row_number() OVER (PARTITION BY symbol, label ORDER BY h, date) AS rn FROM u)
SELECT symbol, date, label FROM r WHERE label = 0 OR rn <= round(n0 * {0.10 / 0.90!r})""")(
    lambda spark, d: G.undersample_positives(_train_labels(spark, d), "unix_date(date)")
                      .select("symbol", "date", "label"))

_IMP_COLS = ["vol_5", "vol_22", "atr_14", "sma_50", "skew_22", "volume_ratio"]
register("median_imputer", _PANEL + "\n" + " UNION ALL ".join(
    f"SELECT symbol, '{c}' AS column_name, {O.sql_rnd(f'quantile_cont({c}, 0.5)', 6)} AS median "
    f"FROM t2 WHERE _rn_pre <= floor(_n_pre * CAST(0.7 AS DOUBLE)) GROUP BY symbol" for c in _IMP_COLS).replace(
    "FROM t2 WHERE", "FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date) AS _rn_pre, "
                     "count(*) OVER (PARTITION BY symbol) AS _n_pre FROM t2) WHERE"))(
    lambda spark, d: round_doubles(PP.fit_median_imputer(
        temporal_split(targets_table(daily_bars_from_lineitem(spark, d))), _IMP_COLS), 6))

_SC_COLS = ["vol_5", "vol_22", "momentum_22", "range_hl", "dow"]
register("standard_scaler", f"""{_PANEL}
""" + " UNION ALL ".join(
    f"SELECT symbol, '{c}' AS column_name, {O.sql_rnd(f'avg({c})', 6)} AS mean, "
    f"{O.sql_rnd(f'CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END', 6)} AS scale "
    f"FROM panel WHERE split = 'train' GROUP BY symbol" for c in _SC_COLS))(
    lambda spark, d: round_doubles(PP.fit_standard_scaler(daily_panel(spark, d), _SC_COLS), 6))


def _gnb(spark, d):
    emb = NB.embeddings_split(read_table(spark, d, "embeddings"))
    long = NB.explode_vectors(emb, "vec_id", "embedding", extra=("label", "split"))
    params = NB.fit_gnb(long.where(F.col("split") == "train"))
    return NB.predict_gnb(long.where(F.col("split") == "test"), params)


register("gnb_embeddings", f"""WITH
e AS (SELECT vec_id, label, {uniform_sql('42', 'vec_id', '0', 'duckdb')} < 0.7 AS is_train, embedding FROM embeddings),
l AS (SELECT vec_id, label, is_train, generate_subscripts(embedding, 1) - 1 AS j,
             CAST(unnest(embedding) AS DOUBLE) AS x FROM e),
fv AS (SELECT max(v) * 1e-09 AS eps FROM (SELECT var_pop(x) AS v FROM l WHERE is_train GROUP BY j)),
pc AS (SELECT label AS class, count(*) AS nc FROM l WHERE is_train AND j = 0 GROUP BY label),
pr AS (SELECT class, ln(nc / (SELECT CAST(sum(nc) AS DOUBLE) FROM pc)) AS lp FROM pc),
th AS (SELECT label AS class, j, avg(x) AS mu, var_pop(x) + (SELECT eps FROM fv) AS var
       FROM l WHERE is_train GROUP BY label, j),
jl AS (SELECT l.vec_id, l.label, th.class,
              sum(-0.5 * ln({2.0 * 3.141592653589793!r} * th.var) - 0.5 * (l.x - th.mu) * (l.x - th.mu) / th.var) AS s
       FROM l JOIN th ON l.j = th.j WHERE NOT l.is_train GROUP BY l.vec_id, l.label, th.class)
SELECT vec_id, label, arg_max(class, s + lp) AS pred FROM jl JOIN pr USING (class) GROUP BY vec_id, label""")(_gnb)

# ---------------------------------------------------------------- F Spark ML families (rows-only)
from ripplet.operators import models as MD  # noqa: E402
from ripplet.session import materialize  # noqa: E402


def _ml_panel(spark, d):
    # Lineage cut: every fit re-reads the written panel, not the raw scan.
    # Rows are spread by a hash of (symbol, date), so a few symbols fill every
    # core once there are enough of them; the number of partitions follows the row count and the order inside
    # one is fixed, so Spark ML's per-partition sampling (bagging, subsampling)
    # reproduces across session configs.
    panel = materialize(daily_panel(spark, d), "ml_panel")
    parts = max(2, -(-panel.count() // 50_000))
    return materialize(panel.repartition(parts, F.xxhash64("symbol", "date")).sortWithinPartitions("symbol", "date"), "ml_rows")


def ml_regression(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    panel = _ml_panel(spark, d)
    ests = MD.regression_estimators(panel.where(F.col("split") == "train"))
    preds, log = MD.fit_and_evaluate(panel, ests, "regression", "target_vol")
    g = MD.fit_gbt(panel, "regression", "target_vol")
    preds = preds.unionByName(MD.predictions_long(g, panel, "gbt", "regression", "target_vol"))
    return preds, log


def ml_classification(spark: SparkSession, d: str) -> DataFrame:
    panel = _ml_panel(spark, d)
    ests = MD.classification_estimators(panel.where(F.col("split") == "train"))
    preds, _ = MD.fit_and_evaluate(panel, ests, "classification", "target_regime")
    g = MD.fit_gbt(panel, "classification", "target_regime")
    preds = preds.unionByName(MD.predictions_long(g, panel, "gbt", "classification", "target_regime"))
    return preds.unionByName(MD.platt_calibrated_svc(panel))


register("ml_regression_metrics", None)(
    lambda spark, d: _r(M.regression_metrics(ml_regression(spark, d)[0]), {"r2": 6}))


def _ml_cls_metrics(spark, d):
    p = materialize(ml_classification(spark, d), "ml_cls_preds")
    return _r(M.roc_auc(p).join(M.classification_metrics(p), ["symbol", "model", "split"]))


register("ml_classification_metrics", None)(_ml_cls_metrics)


def _all_models_wide(spark, d, long: DataFrame, value: str) -> tuple[DataFrame, list[str]]:
    """Test rows with a column for each econometric forecaster and each fitted model."""
    fitted = materialize(long.where("split = 'test'").select("symbol", "date", "model", value), "fitted_test")
    names = sorted(r.model for r in fitted.select("model").distinct().collect())
    wide = fitted.groupBy("symbol", "date").pivot("model", names).agg(F.first(value))
    return materialize(daily_wide_test(spark, d).join(wide, ["symbol", "date"]), "all_models_wide"), names


def _dm_fitted(spark, d):
    """DM test of every pair of forecasters, fitted models included."""
    wide, names = _all_models_wide(spark, d, ml_regression(spark, d)[0], "y_pred")
    return _r(K.bonferroni(K.diebold_mariano(wide, [*MODELS, *names])), {"statistic": 6})


register("dm_pairs_fitted", None)(_dm_fitted)


def _delong_fitted(spark, d):
    """DeLong test of every pair of regime classifiers (fitted scores) and forecasters (score = forecast)."""
    panel = _ml_panel(spark, d)
    ests = {k: v for k, v in MD.classification_estimators(panel.where(F.col("split") == "train")).items() if k in ("tree", "rf", "gaussian_nb")}
    long = MD.fit_and_evaluate(panel, ests, "classification", "target_regime")[0].unionByName(
        MD.predictions_long(MD.fit_gbt(panel, "classification", "target_regime"), panel, "gbt", "classification", "target_regime"))
    wide, names = _all_models_wide(spark, d, long, "score")
    return _r(K.bonferroni(K.delong(wide, [*MODELS, *names])), {"statistic": 6})


register("delong_pairs_fitted", None)(_delong_fitted)

# ---------------------------------------------------------------- streaming (stream == batch)
from ripplet.streaming import bars as SB  # noqa: E402


def _stream_bars(spark, d):
    schema = read_table(spark, d, "events").schema
    sink, _ = SB.run_bars_stream(spark, os.path.join(d, "events.parquet"), schema)
    return _r(SB.latest_bars(spark, sink))


register("stream_bars_hourly", REGISTRY["bars_hourly"][1])(_stream_bars)

# statistics merged over micro-batches equal those of the whole table
from ripplet.streaming import incremental as SI  # noqa: E402


def _incremental_nb(spark, d):
    schema = read_table(spark, d, "embeddings").schema
    sink = SI.run_incremental_gnb(spark, os.path.join(d, "embeddings.parquet"), schema)
    return _r(SI.merged_stats(spark, sink).select("class", "j", "n", "mean", "m2"), {"mean": 7, "m2": 6})


register("incremental_nb_stats", f"""
WITH l AS (SELECT label AS class, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS j, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings)
SELECT class, j, count(x) AS n, {O.sql_rnd('avg(x)', 7)} AS mean, {O.sql_rnd('var_pop(x) * count(x)', 6)} AS m2 FROM l GROUP BY class, j""")(_incremental_nb)

# ---------------------------------------------------------------- E4-E7 fitted econometric models (closed-form checks)
from ripplet.operators import arma_garch as AG  # noqa: E402


def _arma(spark, d):
    return _r(FC.summarize(AG.arma11_forecast(daily_panel(spark, d))))


def _garch_fit_filter(spark, d):
    panel = daily_panel(spark, d)
    params = materialize(AG.garch11_fit(panel), "garch_params")
    return _r(FC.summarize(FC.garch_filter(panel, params=params, model="garch_11_fitted"))
              .join(params, "symbol"))


register("arma_forecast_summary", None)(_arma)
register("garch_fit_summary", None)(_garch_fit_filter)


def _arma_mle(spark, d):
    panel = materialize(daily_panel(spark, d), "arma_panel")
    params = AG.arma11_mle(panel)
    return _r(FC.summarize(AG.arma11_forecast(panel, params.select("symbol", "c", "phi", "theta"), model="arima_101_mle")).join(params, "symbol"))


register("arma_mle_summary", None)(_arma_mle)

# ---------------------------------------------------------------- J8 Q-Q, K4 AUC bootstrap, I7 master table
from ripplet.functions.special import normal_quantile_sql  # noqa: E402

register("qq_points", f"""{_DAILY_PREDS},
res AS (SELECT symbol, model, date, y_true - y_pred AS e FROM preds
        WHERE split = 'test' AND y_true IS NOT NULL AND y_pred IS NOT NULL),
o AS (SELECT symbol, model, e, CAST(row_number() OVER (PARTITION BY symbol, model ORDER BY e, date) AS DOUBLE) AS i,
             CAST(count(*) OVER (PARTITION BY symbol, model) AS DOUBLE) AS n FROM res),
q AS (SELECT symbol, model, i, e, CASE WHEN i = n THEN power(0.5, 1.0 / n) WHEN i = 1 THEN 1.0 - power(0.5, 1.0 / n)
                                    ELSE (i - 0.3175) / (n + 0.365) END AS pp FROM o)
SELECT symbol, model, CAST(i AS INTEGER) AS i, {O.sql_rnd('pp')} AS pp,
       {O.sql_rnd(normal_quantile_sql('pp'), 6)} AS theoretical, {O.sql_rnd('e')} AS sample FROM q""")(
    lambda spark, d: _r(J.qq_points(daily_preds(spark, d)), {"theoretical": 6}))

register("bootstrap_auc_ci", f"""{_CLS},
bt AS (SELECT symbol, model, label, score,
              row_number() OVER (PARTITION BY symbol, model ORDER BY date) - 1 AS pos,
              count(*) OVER (PARTITION BY symbol, model) AS n
       FROM cls WHERE split = 'test' AND label IS NOT NULL AND score IS NOT NULL),
dr AS (SELECT symbol, model, r.b, {index_sql('42', 'r.b', 'pos', 'n', 'duckdb')} AS idx
       FROM bt CROSS JOIN range(0, {_B}) r(b)),
mu AS (SELECT symbol, model, b, idx, count(*) AS w FROM dr GROUP BY ALL),
j AS (SELECT mu.symbol, mu.model, mu.b, bt.score, mu.w, bt.label FROM mu JOIN bt
      ON mu.symbol = bt.symbol AND mu.model = bt.model AND mu.idx = bt.pos),
c AS (SELECT symbol, model, b, score, sum(CASE WHEN label = 1 THEN w ELSE 0 END) AS pos,
             sum(CASE WHEN label = 0 THEN w ELSE 0 END) AS neg FROM j GROUP BY ALL),
c2 AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY symbol, model, b ORDER BY score
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb FROM c),
rep AS (SELECT symbol, model, b, CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN
               sum(pos * (nb + 0.5 * neg)) / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) END AS auc_b
        FROM c2 GROUP BY ALL)
SELECT symbol, model, {O.sql_rnd('quantile_cont(auc_b, 0.025)')} AS ci_lo, {O.sql_rnd('quantile_cont(auc_b, 0.975)')} AS ci_hi,
       count(auc_b) AS n_boot, count(*) FILTER (WHERE auc_b IS NULL) AS n_undefined FROM rep GROUP BY ALL""")(
    lambda spark, d: _r(K.bootstrap_auc_ci(daily_wide_test(spark, d), MODELS, n_boot=_B)))


def _master(spark, d):
    wide = materialize(FC.add_forecasts(daily_panel(spark, d)), "forecasts_wide")
    reg = FC.summarize(FC.to_long(wide), ("symbol", "model", "split"))
    cls = M.roc_auc(M.regime_scores_wide(wide, FC.MODELS))
    return _r(M.master_table(reg, cls))


register("master_table", f"""{_CLS}{_SC},
sc2 AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY symbol, model, split ORDER BY score
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb FROM sc),
au AS (SELECT symbol, model, split, sum(pos * (nb + 0.5 * neg)) / NULLIF(CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE), 0) AS auc
       FROM sc2 GROUP BY ALL),
rg AS (SELECT symbol, model, split, sqrt(avg((y_pred - y_true) * (y_pred - y_true))) AS rmse, avg(abs(y_pred - y_true)) AS mae
       FROM preds WHERE y_pred IS NOT NULL AND y_true IS NOT NULL GROUP BY ALL),
u AS (SELECT 'forecast' AS family, symbol, split, model, rmse, mae, CAST(NULL AS DOUBLE) AS auc FROM rg
      UNION ALL SELECT 'regime', symbol, split, model, NULL, NULL, auc FROM au)
SELECT family, symbol, split, model, {O.sql_rnd('rmse')} AS rmse, {O.sql_rnd('mae')} AS mae, {O.sql_rnd('auc')} AS auc,
       row_number() OVER (PARTITION BY family, symbol, split
                          ORDER BY CASE WHEN family = 'forecast' THEN rmse ELSE -auc END, model) AS rank
FROM u""")(_master)

register("residuals_vs_prediction", f"""{_DAILY_PREDS}
SELECT symbol, model, date, {O.sql_rnd('y_pred')} AS y_pred, {O.sql_rnd('y_true - y_pred')} AS e FROM preds WHERE split = 'test'""")(
    lambda spark, d: _r(J.residuals_vs_prediction(daily_preds(spark, d))))

# D8 valid rows, A2 cleaned range
from ripplet.operators.splits import valid_rows  # noqa: E402
from ripplet.sources.bars import clean_range  # noqa: E402

register("valid_row_counts", f"""{_PANEL}
SELECT symbol, split, count(*) AS n_rows FROM panel WHERE target_vol IS NOT NULL AND target_regime IS NOT NULL GROUP BY ALL""")(
    lambda spark, d: valid_rows(daily_panel(spark, d), ("target_vol", "target_regime")).groupBy("symbol", "split").agg(F.count(F.lit(1)).alias("n_rows")))

register("bars_clean_range", f"""
WITH b AS ({O.daily_bars_sql()})
SELECT {O.select_rounded(BAR_COLS, SIX)} FROM b WHERE close IS NOT NULL AND date BETWEEN DATE '1994-01-01' AND DATE '1996-12-31'""")(
    lambda spark, d: _r(clean_range(daily_bars_from_lineitem(spark, d), "1994-01-01", "1996-12-31")))

# ---------------------------------------------------------------- H search (rows-only)
from ripplet.operators import search as H  # noqa: E402

SEARCH_ROUNDS = 200  # boosting rounds of a candidate (H1); the refit (H8) grows until patience ends it


def _boosted_scores(spark, d):
    train = materialize(daily_panel(spark, d), "search_panel").where(F.col("split") == "train").drop("split")
    table = H.cv_table(train, FEATURE_COLUMNS)
    return lambda cands: H.cv_scores(table, cands, SEARCH_ROUNDS)


def _grid_and_random(spark, d) -> dict[str, list]:
    """24 grid and 20 random candidates, 132 models with their folds, in one run."""
    asked = {"grid": H.grid_candidates(H.BOOSTED_GRID), "random": H.random_candidates(H.BOOSTED_SPACE, 20)}
    scores = iter(_boosted_scores(spark, d)([c for cands in asked.values() for c in cands]))
    return {m: [(c, next(scores)) for c in cands] for m, cands in asked.items()}


def _search(spark, d):
    logs = [H.search_log(spark, m, t) for m, t in _grid_and_random(spark, d).items()]
    return _r(H.best_so_far(logs[0].unionByName(logs[1])))


register("search_best_so_far", None)(_search)
register("search_tpe", None)(
    lambda spark, d: _r(H.best_so_far(H.search_log(spark, "tpe", H.tpe_search(_boosted_scores(spark, d), H.BOOSTED_SPACE, n_trials=20)))))
register("search_genetic", None)(
    lambda spark, d: _r(H.best_so_far(H.search_log(spark, "genetic", H.genetic_search(_boosted_scores(spark, d), H.BOOSTED_SPACE, pop=8, gens=2)))))


def _refit(spark, d):
    best = {m: min(t, key=lambda x: x[1])[0] for m, t in _grid_and_random(spark, d).items()}
    return _r(H.refit_best(_ml_panel(spark, d), FEATURE_COLUMNS, best)[1], {"r2": 6})


register("search_refit", None)(_refit)

# ---------------------------------------------------------------- L explanation
from ripplet.operators import explain as L  # noqa: E402
from ripplet.operators import shap as S  # noqa: E402

_CASES = ["high_hit", "low_hit", "worst_over", "worst_under"]
register("representative_cases", f"""{_DAILY_PREDS},
dd AS (SELECT symbol, model, date, y_true, y_pred, y_pred - y_true AS e,
              quantile_cont(y_true, 0.9) OVER (PARTITION BY symbol, model) AS p90,
              quantile_cont(y_true, 0.1) OVER (PARTITION BY symbol, model) AS p10
       FROM preds WHERE split = 'test' AND y_true IS NOT NULL AND y_pred IS NOT NULL),
ag AS (SELECT symbol, model,
         arg_max({{'date': date, 'y_true': y_true, 'y_pred': y_pred}}, {{'y': y_true, 'd': date}}) FILTER (WHERE y_true > p90 AND abs(e) < 0.001) AS high_hit,
         arg_min({{'date': date, 'y_true': y_true, 'y_pred': y_pred}}, {{'y': y_true, 'd': date}}) FILTER (WHERE y_true < p10 AND abs(e) < 0.001) AS low_hit,
         arg_max({{'date': date, 'y_true': y_true, 'y_pred': y_pred}}, {{'e': e, 'd': date}}) AS worst_over,
         arg_min({{'date': date, 'y_true': y_true, 'y_pred': y_pred}}, {{'e': e, 'd': date}}) AS worst_under
       FROM dd GROUP BY symbol, model),
lg AS ({" UNION ALL ".join(f"SELECT symbol, model, '{c}' AS case_name, {c} AS r FROM ag" for c in _CASES)})
SELECT symbol, model, case_name AS "case", r.date AS date, {O.sql_rnd('r.y_true')} AS y_true, {O.sql_rnd('r.y_pred')} AS y_pred
FROM lg WHERE r IS NOT NULL""")(
    lambda spark, d: _r(L.representative_cases(daily_preds(spark, d))))


def _importance(spark, d):
    panel = _ml_panel(spark, d)
    feats = list(FEATURE_COLUMNS)
    model = MD.fit_gbt(panel, "regression", "target_vol", feats)
    test = panel.where(F.col("split") == "test")
    gain = L.native_importance(model, spark).select(F.lit("gain").alias("method"), "feature", F.col("gain").alias("score"))
    perm = L.permutation_importance(model, test, feats, "target_vol") \
            .select(F.lit("permutation").alias("method"), "feature", F.col("importance_mean").alias("score"))
    shap = S.shap_importance(S.tree_shap(model, test, ["symbol", "date"]), feats) \
            .select(F.lit("shap").alias("method"), "feature", F.col("mean_abs_shap").alias("score"))
    scores = materialize(gain.unionByName(perm).unionByName(shap), "importance_scores")
    return _r(L.combined_importance(scores))


def _shap(spark, d):
    """phi of every test row and feature of the boosted regressor, with the row's base and margin."""
    panel = _ml_panel(spark, d)
    model = MD.fit_gbt(panel, "regression", "target_vol")
    values = S.tree_shap(model, panel.where(F.col("split") == "test"), ["symbol", "date"])
    name = F.element_at(F.array(*[F.lit(f) for f in FEATURE_COLUMNS]), F.col("j") + 1)
    return _r(values.select("symbol", "date", "base", "margin", F.posexplode("phi").alias("j", "phi")).withColumn("feature", name).drop("j"))


register("tree_shap", None)(_shap)
register("combined_importance", None)(_importance)

# ---------------------------------------------------------------- M mixture / ensemble / ablation (rows-only)
from ripplet.operators import mixture as MX  # noqa: E402


def _ablation(spark, d):
    comps = materialize(MX.mixture_components(_ml_panel(spark, d)), "mixture_components")
    return _r(MX.ablation(comps), {"r2": 6})


register("mixture_ablation", None)(_ablation)

# ---------------------------------------------------------------- J5 BDS
from ripplet.operators import bds as BDS  # noqa: E402


def _bds_sql(max_dim: int = 3) -> str:
    P = "PARTITION BY symbol, model"
    dims = []
    for m in range(2, max_dim + 1):
        joins = " ".join(f"JOIN pr p{k} ON p{k}.symbol = p0.symbol AND p{k}.model = p0.model "
                         f"AND p{k}.i = p0.i - {k} AND p{k}.j = p0.j - {k}" for k in range(1, m))
        dims.append(f"pm{m} AS (SELECT p0.symbol, p0.model, count(*) AS pm FROM pr p0 {joins} GROUP BY ALL)")
    stat_rows = []
    for m in range(2, max_dim + 1):
        npair = f"((n - {m} + 1) * (n - {m}) / 2.0)"
        tmp = " + ".join(f"power(k, {m - j}) * power(c1, {2 * j})" for j in range(1, m))
        var = (f"4.0 * (power(k, {m}) + 2.0 * ({tmp}) + {(m - 1) ** 2}.0 * power(c1, {2 * m}) "
               f"- {m * m}.0 * k * power(c1, {2 * m - 2}))")
        stat = f"sqrt(n - {m} + 1.0) * (coalesce(pm{m}.pm, 0) / {npair} - power(p1_{m} / {npair}, {m})) / sqrt({var})"
        stat_rows.append(f"SELECT st.symbol, st.model, eps, {m} AS dim, {stat} AS statistic FROM st "
                         f"LEFT JOIN pm{m} ON pm{m}.symbol = st.symbol AND pm{m}.model = st.model")
    return f"""{_DAILY_PREDS},
res AS (SELECT symbol, model, y_true - y_pred AS x,
               row_number() OVER ({P} ORDER BY date) - 1 AS t FROM preds
        WHERE split = 'test' AND y_true IS NOT NULL AND y_pred IS NOT NULL),
rs AS (SELECT *, count(*) OVER ({P}) AS n, 0.5 * stddev_pop(x) OVER ({P}) AS eps FROM res),
pr AS (SELECT a.symbol, a.model, a.t AS i, b.t AS j FROM rs a JOIN rs b
       ON a.symbol = b.symbol AND a.model = b.model AND a.t < b.t AND abs(a.x - b.x) < a.eps),
dg AS (SELECT symbol, model, v, count(*) AS d FROM (SELECT symbol, model, i AS v FROM pr UNION ALL
                                                    SELECT symbol, model, j FROM pr) GROUP BY ALL),
ds AS (SELECT symbol, model, sum(d * d) AS sum_d2 FROM dg GROUP BY ALL),
cn AS (SELECT symbol, model, count(*) AS p1, {", ".join(f"count(*) FILTER (WHERE i >= {m - 1}) AS p1_{m}" for m in range(2, max_dim + 1))}
       FROM pr GROUP BY ALL),
mt AS (SELECT symbol, model, CAST(any_value(n) AS DOUBLE) AS n, any_value(eps) AS eps FROM rs GROUP BY ALL),
st0 AS (SELECT mt.*, coalesce(cn.p1, 0) AS p1, coalesce(ds.sum_d2, 0) AS sum_d2,
               {", ".join(f"coalesce(cn.p1_{m}, 0) AS p1_{m}" for m in range(2, max_dim + 1))}
        FROM mt LEFT JOIN cn USING (symbol, model) LEFT JOIN ds USING (symbol, model)),
st AS (SELECT *, p1 / (n * (n - 1) / 2.0) AS c1,
              ((n + 4 * p1 + sum_d2) - 3 * (n + 2 * p1) + 2 * n) / (n * (n - 1) * (n - 2)) AS k FROM st0),
{", ".join(dims)},
bd AS ({" UNION ALL ".join(stat_rows)})
SELECT symbol, model, {O.sql_rnd('eps')} AS eps, dim, {O.sql_rnd('statistic', 6)} AS statistic,
       {O.sql_rnd(normal_two_sided_p_sql('statistic'))} AS p_value FROM bd"""


register("bds_residuals", _bds_sql())(
    lambda spark, d: _r(BDS.bds_residuals(daily_preds(spark, d)).withColumn("dim", F.col("dim").cast("int")),
                        {"statistic": 6}))

_BDS_SUMMARY = ", ".join(f"max({c}) FILTER (WHERE dim = {m}) AS bds_{n}_{m}"
                         for m in (2, 3) for n, c in (("stat", "statistic"), ("p", "p_value")))
register("residual_summary", f"""SELECT s.*, b.* EXCLUDE (symbol, model) FROM ({REGISTRY["residual_summary"][1]}) s
LEFT JOIN (SELECT symbol, model, {_BDS_SUMMARY} FROM ({_bds_sql()}) GROUP BY ALL) b USING (symbol, model)""")(
    lambda spark, d: _r(J.residual_summary(daily_preds(spark, d)), {**_SUM_DIG, "bds_stat_2": 6, "bds_stat_3": 6}))


def _preds_with(spark, d, regressors):
    wide = FC.add_forecasts(daily_panel(spark, d))
    keys = ["symbol", "date", "split", "y_true", *regressors]
    return (wide.withColumn("y_true", F.col("target_vol")).select(*keys, *[F.col(m).cast("double") for m in FC.MODELS])
                .unpivot(keys, list(FC.MODELS), "model", "y_pred"))


register("variance_tests_x", f"""{_DAILY_PREDS},
xr AS (SELECT p.symbol, p.model, CAST(t.vol_22 AS DOUBLE) AS x, (p.y_true - p.y_pred) * (p.y_true - p.y_pred) AS u
       FROM preds p JOIN panel t ON t.symbol = p.symbol AND t.date = p.date
       WHERE p.split = 'test' AND p.y_true IS NOT NULL AND p.y_pred IS NOT NULL AND t.vol_22 IS NOT NULL),
xs AS (SELECT symbol, model, count(*) AS n, var_pop(x) AS v11, var_pop(x * x) AS v22, covar_pop(x, x * x) AS v12,
              covar_pop(x, u) AS c1, covar_pop(x * x, u) AS c2, var_pop(u) AS vu FROM xr GROUP BY ALL),
xt AS (SELECT symbol, model, 'white' AS test, n * ((c1 * v22 - c2 * v12) * c1 + (c2 * v11 - c1 * v12) * c2) / (v11 * v22 - v12 * v12) / vu AS statistic, 2 AS dof FROM xs
       UNION ALL SELECT symbol, model, 'breusch_pagan', n * c1 * c1 / (v11 * vu), 1 FROM xs)
SELECT symbol, model, test, {O.sql_rnd('statistic', 5)} AS statistic, dof,
       {O.sql_rnd(f"CASE WHEN dof = 1 THEN {chi2_sf_sql('statistic', 1)} ELSE {chi2_sf_sql('statistic', 2)} END", 6)} AS p_value FROM xt""")(
    lambda spark, d: round_doubles(J.variance_tests(_preds_with(spark, d, ["vol_22"]), ["vol_22"]), 6, {"statistic": 5}))

# ---------------------------------------------------------------- D9 leakage audit (rows-only; expects n_diff = 0)
from ripplet.operators.leakage import feature_leakage_audit  # noqa: E402

register("leakage_audit", None)(lambda spark, d: feature_leakage_audit(daily_bars_from_lineitem(spark, d)))

# ---------------------------------------------------------------- F6 kNN, G1 SMOTE, G2 ADASYN (embeddings)
from ripplet.operators import knn as KNN  # noqa: E402


def _emb_split(spark, d):
    return NB.embeddings_split(read_table(spark, d, "embeddings"))


def _knn(spark, d):
    e = _emb_split(spark, d)
    return _r(KNN.knn_predict(e.where(F.col("split") == "test"), e.where(F.col("split") == "train"), k=15))


register("knn_embeddings", f"""WITH
e AS (SELECT vec_id, label, {uniform_sql('42', 'vec_id', '0', 'duckdb')} < 0.7 AS is_train, embedding FROM embeddings),
l AS (SELECT vec_id, label, is_train, generate_subscripts(embedding, 1) AS j, CAST(unnest(embedding) AS DOUBLE) AS x FROM e),
dd AS (SELECT q.vec_id AS qid, r.vec_id AS rid, sqrt(sum((q.x - r.x) * (q.x - r.x))) AS dist
       FROM l q JOIN l r ON q.j = r.j WHERE NOT q.is_train AND r.is_train GROUP BY q.vec_id, r.vec_id),
nn AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, rid) AS rk FROM dd),
top AS (SELECT nn.qid, e.label AS y FROM nn JOIN e ON e.vec_id = nn.rid WHERE rk <= 15),
votes AS (SELECT qid, y, count(*) AS v FROM top GROUP BY ALL),
pred AS (SELECT qid, arg_min(y, (-v, y)) AS pred FROM votes GROUP BY qid),
mean AS (SELECT qid, avg(CAST(y AS DOUBLE)) AS mean_label FROM top GROUP BY qid)
SELECT e.vec_id, e.label, pred.pred, {O.sql_rnd('mean.mean_label')} AS mean_label
FROM e JOIN pred ON pred.qid = e.vec_id JOIN mean ON mean.qid = e.vec_id""")(_knn)


def _binary_train(spark, d):
    e = _emb_split(spark, d).where(F.col("split") == "train")
    return e.withColumn("y", (F.col("label") == 0).cast("int"))


_OVER = f"""WITH
e AS (SELECT vec_id, embedding, CAST(label = 0 AS INTEGER) AS y FROM embeddings WHERE {uniform_sql('42', 'vec_id', '0', 'duckdb')} < 0.7),
cn AS (SELECT y, count(*) AS n FROM e GROUP BY y),
mi AS (SELECT arg_min(y, (n, y)) AS y, min(n) AS n, max(n) - min(n) AS g FROM cn),
mino AS (SELECT vec_id FROM e WHERE y = (SELECT y FROM mi)),
l AS (SELECT vec_id, y, generate_subscripts(embedding, 1) AS j, CAST(unnest(embedding) AS DOUBLE) AS x FROM e),
dd AS (SELECT q.vec_id AS qid, r.vec_id AS rid, any_value(r.y) AS ry, sqrt(sum((q.x - r.x) * (q.x - r.x))) AS dist
       FROM l q JOIN l r ON q.j = r.j WHERE q.y = (SELECT y FROM mi) AND q.vec_id <> r.vec_id GROUP BY q.vec_id, r.vec_id),
nm AS (SELECT qid, rid, row_number() OVER (PARTITION BY qid ORDER BY dist, rid) AS rk FROM dd WHERE ry = (SELECT y FROM mi))"""

register("smote_embeddings", f"""{_OVER},
sd AS (SELECT vec_id, row_number() OVER (ORDER BY {index_sql('0', 'vec_id', '0', 'greatest(1, ceil(n / 100000.0))', 'duckdb')}, vec_id) - 1 AS i
       FROM mino, mi),
sy AS (SELECT r.s AS synthetic_id, {index_sql('42', 'r.s', '1', 'mi.n', 'duckdb')} AS i,
              {index_sql('42', 'r.s', '2', 'least(5, mi.n - 1)', 'duckdb')} + 1 AS rk, {uniform_sql('42', 'r.s', '3', 'duckdb')} AS u
       FROM mi, (SELECT unnest(range((SELECT g FROM mi))) AS s) r)
SELECT synthetic_id, sd.vec_id AS seed_id, rid AS neighbour_id, {O.sql_rnd('u')} AS u, (SELECT y FROM mi) AS y
FROM sy JOIN sd USING (i) JOIN nm ON nm.qid = sd.vec_id AND nm.rk = sy.rk""")(
    lambda spark, d: _r(KNN.smote(_binary_train(spark, d), k=5).select("synthetic_id", "seed_id", "neighbour_id", "u", "y")))
register("adasyn_embeddings", f"""{_OVER},
al AS (SELECT qid, ry, row_number() OVER (PARTITION BY qid ORDER BY dist, rid) AS rk FROM dd),
ra AS (SELECT qid, count(*) FILTER (WHERE ry <> (SELECT y FROM mi)) / 5.0 AS r FROM al WHERE rk <= 5 GROUP BY qid),
gi AS (SELECT qid, CAST(round(r / (SELECT sum(r) FROM ra) * CAST((SELECT g FROM mi) AS DOUBLE)) AS INTEGER) AS g FROM ra),
ge AS (SELECT qid, unnest(range(g)) AS s FROM gi WHERE g > 0),
gd AS (SELECT qid, {index_sql('42', 'qid', 's', 'least(5, mi.n - 1)', 'duckdb')} + 1 AS rk, {uniform_sql('42', 'qid', 's + 100000', 'duckdb')} AS u FROM ge, mi)
SELECT 'generated' AS status, gd.qid AS seed_id, rid AS neighbour_id, {O.sql_rnd('u')} AS u, (SELECT y FROM mi) AS y
FROM gd JOIN nm ON nm.qid = gd.qid AND nm.rk = gd.rk""")(
    lambda spark, d: _r(KNN.adasyn(_binary_train(spark, d), k=5).drop("embedding")))

# ---------------------------------------------------------------- G6 model x technique matrix (rows-only)
def _technique_matrix(spark, d):
    res = materialize(G.balancing_experiment(_ml_panel(spark, d)), "balancing_results")
    auc = res.groupBy("symbol", "model").pivot("technique", ["none", "undersample", "class_weight", "smote", "adasyn"]) \
             .agg(F.first("auc"))
    return _r(auc)


register("balancing_auc_matrix", None)(_technique_matrix)

# ---------------------------------------------------------------- F9 / F10 kernel machines on random Fourier features
from ripplet.operators import kernel as KR  # noqa: E402

register("rff_svr_metrics", None)(
    lambda spark, d: _r(M.regression_metrics(KR.rff_svr(_ml_panel(spark, d))), {"r2": 6}))


def _rff_svc(spark, d):
    p = materialize(KR.rff_svc(_ml_panel(spark, d)), "rff_svc_preds")
    return _r(M.roc_auc(p).join(M.classification_metrics(p), ["symbol", "model", "split"]))


register("rff_svc_metrics", None)(_rff_svc)


def _lime(spark, d):
    panel = _ml_panel(spark, d)
    model = MD.fit_gbt(panel, "regression", "target_vol")
    feats = list(FEATURE_COLUMNS)
    # Instances: representative cases of the (deterministic) persistence forecaster.
    cases = L.representative_cases(FC.naive(panel)).select("symbol", "date").distinct()
    inst = panel.join(cases, ["symbol", "date"])
    return _r(L.lime(model, panel.where(F.col("split") == "train"), inst, feats))


register("lime_explanations", None)(_lime)

# ---------------------------------------------------------------- A3 provenance, D7 hold-out
from ripplet.operators.splits import chronological_holdout  # noqa: E402
from ripplet.sources.bars import load_panel_bars  # noqa: E402

register("bars_with_provenance", f"""
WITH b AS ({O.daily_bars_sql()})
SELECT {O.select_rounded(BAR_COLS, SIX)}, 'lineitem_transactions' AS source FROM b""")(
    lambda spark, d: _r(load_panel_bars(spark, d, csv_glob=os.path.join(d, "*.us.txt"))))

register("train_holdout_split", f"""{_PANEL},
tr AS (SELECT symbol, date, row_number() OVER (PARTITION BY symbol ORDER BY date) AS rn,
              CAST(count(*) OVER (PARTITION BY symbol) AS DOUBLE) AS n FROM panel WHERE split = 'train')
SELECT symbol, date, CASE WHEN rn <= n - floor(n * CAST(0.15 AS DOUBLE)) THEN 'fit' ELSE 'holdout' END AS role FROM tr""")(
    lambda spark, d: chronological_holdout(daily_panel(spark, d).where(F.col("split") == "train"))
                      .select("symbol", "date", "role"))


register("arma_refit_summary", None)(
    lambda spark, d: _r(FC.summarize(AG.arma11_refit_forecast(daily_panel(spark, d), refit_every=250))))

# ---------------------------------------------------------------- D5 panel variant: shared calendar cut dates
from ripplet.operators.splits import panel_cut_dates  # noqa: E402

register("panel_cut_dates", f"""{_PANEL},
pd_ AS (SELECT date, count(*) AS c FROM panel GROUP BY date),
cu AS (SELECT date, sum(c) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
              sum(c) OVER () AS n FROM pd_)
SELECT date, CASE WHEN cum <= floor(n * CAST(0.7 AS DOUBLE)) THEN 'train'
                  WHEN cum <= floor(n * CAST(0.7 AS DOUBLE)) + floor(n * CAST(0.15 AS DOUBLE)) THEN 'val'
                  ELSE 'test' END AS split FROM cu""")(
    lambda spark, d: panel_cut_dates(daily_panel(spark, d)))

# ---------------------------------------------------------------- D4 provenance metadata
from ripplet.operators.targets import target_metadata  # noqa: E402

register("target_metadata", f"""{_PANEL}
SELECT symbol, {O.sql_rnd('any_value(regime_threshold)')} AS regime_threshold,
       count(*) FILTER (WHERE split = 'train') AS train_size, count(*) FILTER (WHERE split = 'val') AS val_size,
       count(*) FILTER (WHERE split = 'test') AS test_size, 1 AS horizon, 5 AS vol_window,
       'train_quantile' AS regime_threshold_source
FROM panel GROUP BY symbol""")(lambda spark, d: _r(target_metadata(daily_panel(spark, d))))
