"""Residual diagnostics (J1-J8) per (symbol, model), one aggregation each.

Input: long predictions (symbol, date, split, model, y_true, y_pred).
Residuals e = y_true - y_pred on one split, time index t = 0..n-1 by date.
Each test is a closed form over sufficient statistics (sums, centred
moments, lagged cross-products), so every (symbol, model) series is reduced
on executors; p-values are arithmetic expressions (no Python on rows)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ripplet.functions.special import chi2_sf_sql, erfc_sql
from ripplet.operators.explore import acf

KEYS = ("symbol", "model")


def residual_table(preds: DataFrame, split: str = "test", keys=KEYS) -> DataFrame:
    ok = (preds.where((F.col("split") == split) & F.col("y_true").isNotNull() & F.col("y_pred").isNotNull())
               .select(*keys, "date", (F.col("y_true") - F.col("y_pred")).alias("e")))
    w = Window.partitionBy(*keys).orderBy("date")
    return ok.withColumn("t", (F.row_number().over(w) - 1).cast("double"))


def _test_columns(st: DataFrame) -> DataFrame:
    """Test statistics from one row of sufficient statistics; a series without the variation a test needs (constant
    residuals, too few rows) gets NULL and never ends the job."""
    n = F.col("n").cast("double")
    # White (X = [1, t]): regress e^2 on [1, t, t^2]; R^2 from the centred 2x2 system.
    det = F.col("v11") * F.col("v22") - F.col("v12") * F.col("v12")
    b1 = F.try_divide(F.col("c1") * F.col("v22") - F.col("c2") * F.col("v12"), det)
    b2 = F.try_divide(F.col("c2") * F.col("v11") - F.col("c1") * F.col("v12"), det)
    # Jarque-Bera with population skewness / excess kurtosis.
    return st.withColumns({
        "white_stat": n * F.try_divide(b1 * F.col("c1") + b2 * F.col("c2"), F.col("vu")),
        # Breusch-Pagan (Koenker): n * corr(e^2, t)^2.
        "bp_stat": n * F.try_divide(F.col("c1") * F.col("c1"), F.col("v11") * F.col("vu")),
        "ljung_box_stat": F.col("lb"),
        "jb_stat": n / 6.0 * (F.col("skew_pop") ** 2 + F.col("kurt_pop") ** 2 / 4.0)})


TESTS = (("white", "white_stat", 2), ("breusch_pagan", "bp_stat", 1), ("ljung_box(lag=10)", "ljung_box_stat", 10),
         ("jarque_bera", "jb_stat", 2))


def _tests_from_stats(st: DataFrame, keys) -> DataFrame:
    """White, Breusch-Pagan, Ljung-Box and Jarque-Bera from one stats row."""
    return _test_columns(st).select(*keys, F.inline(F.array(*[
        F.struct(F.lit(name).alias("test"), F.col(c).alias("statistic"), F.expr(chi2_sf_sql(c, dof)).alias("p_value"))
        for name, c, dof in TESTS])))


def residual_stats(res: DataFrame, keys=KEYS, lb_lags: int = 10) -> DataFrame:
    """One row of sufficient statistics per series (all tests + descriptives)."""
    wk = Window.partitionBy(*keys)
    wo = Window.partitionBy(*keys).orderBy("date")
    d = res.withColumns({"_u": F.col("e") * F.col("e"), "_t2": F.col("t") * F.col("t"),
                         "_d": F.col("e") - F.avg("e").over(wk)})
    d = d.withColumns({f"_l{k}": F.lag("_d", k).over(wo) for k in range(1, lb_lags + 1)})
    agg = d.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.avg("e").alias("mean"), F.stddev_samp("e").alias("std"),
        F.min("e").alias("min"), F.max("e").alias("max"),
        F.nanvl(F.skewness("e"), F.lit(None)).alias("skew_pop"), F.nanvl(F.kurtosis("e"), F.lit(None)).alias("kurt_pop"),
        F.var_pop("t").alias("v11"), F.var_pop("_t2").alias("v22"), F.covar_pop("t", "_t2").alias("v12"),
        F.covar_pop("t", "_u").alias("c1"), F.covar_pop("_t2", "_u").alias("c2"), F.var_pop("_u").alias("vu"),
        F.sum(F.col("_d") * F.col("_d")).alias("_g0"),
        *[F.sum(F.col("_d") * F.col(f"_l{k}")).alias(f"_g{k}") for k in range(1, lb_lags + 1)])
    n = F.col("n").cast("double")
    q = None
    for k in range(1, lb_lags + 1):
        term = F.when(n > k, F.try_divide(F.try_divide(f"_g{k}", "_g0") ** 2, n - k))
        q = term if q is None else q + term
    return agg.withColumn("lb", n * (n + 2) * q)


def residual_tests(preds: DataFrame, split: str = "test", keys=KEYS) -> DataFrame:
    """J1-J4 as one row per (symbol, model, test): statistic, p_value."""
    return _tests_from_stats(residual_stats(residual_table(preds, split, keys), keys), keys)


def residual_summary(preds: DataFrame, split: str = "test", keys=KEYS, max_dim_bds: int = 3) -> DataFrame:
    """Descriptives (n, mean, std ddof 1, min, max, population skew and
    excess kurtosis) next to every test statistic and p-value, computed as
    columns of the single statistics row, and the BDS statistics of dimensions
    2..``max_dim_bds`` (0: without)."""
    st = _test_columns(residual_stats(residual_table(preds, split, keys), keys))
    st = st.withColumns({c.replace("_stat", "_p"): F.expr(chi2_sf_sql(c, dof)) for _, c, dof in TESTS})
    out = st.select(*keys, "n", "mean", "std", "min", "max", F.col("skew_pop").alias("skew"),
                    F.col("kurt_pop").alias("kurtosis"), "white_stat", "white_p", "bp_stat", "bp_p",
                    "ljung_box_stat", "ljung_box_p", "jb_stat", "jb_p")
    if not max_dim_bds:
        return out
    from ripplet.operators.bds import bds_residuals
    bds = bds_residuals(preds, split, max_dim_bds, keys).groupBy(*keys).agg(*[
        F.max(F.when(F.col("dim") == m, F.col(c))).alias(f"bds_{n}_{m}")
        for m in range(2, max_dim_bds + 1) for n, c in (("stat", "statistic"), ("p", "p_value"))])
    return out.join(bds, list(keys), "left")


def variance_tests(preds: DataFrame, regressors: list[str], split: str = "test", keys=KEYS) -> DataFrame:
    """J1 / J2 with a general X: White (squares and cross products of [1, X]) and Breusch-Pagan (Koenker), n * R^2 of the
    regression of e^2 on the terms.  ``preds`` carries the regressor columns; rows with a NULL regressor are left out.

    Per series the (terms x terms) cross-product sums are one aggregation; the small system is solved per series, and
    one that is singular or has no variation in e^2 gives NULL."""
    import numpy as np
    import pandas as pd
    x = [F.col(c).cast("double") for c in regressors]
    res = preds.where((F.col("split") == split) & F.col("y_true").isNotNull() & F.col("y_pred").isNotNull())
    for c in regressors:
        res = res.where(F.col(c).isNotNull())
    linear = list(x)
    square = [a * b for i, a in enumerate(x) for b in x[i:]]
    terms = [F.lit(1.0), *linear, *square, (F.col("y_true") - F.col("y_pred")) ** 2]
    names = [f"_t{i}" for i in range(len(terms))]
    df = res.select(*keys, *[t.alias(c) for t, c in zip(terms, names)])
    # standardised columns keep the sums well scaled; R^2 does not change
    w = Window.partitionBy(*keys)
    df = df.withColumns({c: F.coalesce(F.try_divide(F.col(c) - F.avg(c).over(w), F.stddev_pop(c).over(w)), F.lit(0.0)) for c in names[1:]})
    pairs = [(i, j) for i in range(1, len(names)) for j in range(i, len(names))]
    agg = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.array(*[F.sum(F.col(names[i]) * F.col(names[j])) for i, j in pairs]).alias("g"))
    k, m = len(names) - 1, len(linear)

    def solve(batches):
        for pdf in batches:
            rows = []
            for rec in pdf.to_dict("records"):
                full = np.zeros((k, k))
                for (i, j), v in zip(pairs, rec["g"]):
                    full[i - 1, j - 1] = full[j - 1, i - 1] = v
                for name, size in (("white", k - 1), ("breusch_pagan", m)):
                    a, b, total = full[:size, :size], full[:size, -1], full[-1, -1]
                    rank = int(np.linalg.matrix_rank(a, hermitian=True)) if size else 0
                    stat = float(rec["n"] * (b @ np.linalg.lstsq(a, b, rcond=None)[0]) / total) if total > 0 and rank else None
                    rows.append({**{c: rec[c] for c in keys}, "test": name, "statistic": stat, "dof": rank})
            yield pd.DataFrame(rows, columns=[*keys, "test", "statistic", "dof"])

    schema = ", ".join(f"{c} string" for c in keys) + ", test string, statistic double, dof int"
    out = agg.mapInPandas(solve, schema)
    top = (len(linear) * (len(linear) + 3)) // 2
    p = F.coalesce(*[F.when(F.col("dof") == d, F.expr(chi2_sf_sql("statistic", d))) for d in range(1, top + 1)])
    return out.withColumn("p_value", F.when(F.col("statistic").isNotNull(), p))


def residual_acf(preds: DataFrame, split: str = "test", n_lags: int = 30, keys=KEYS) -> DataFrame:
    """Residual ACF up to ``n_lags``."""
    return acf(residual_table(preds, split, keys), "e", n_lags, keys)


# Filliben (1975) order-statistic median constants.
FILLIBEN_A, FILLIBEN_B = 0.3175, 0.365


def qq_points(preds: DataFrame, split: str = "test", keys=KEYS) -> DataFrame:
    """Ordered residuals against normal quantiles at Filliben's
    order-statistic medians m_i = (i - 0.3175) / (n + 0.365), with
    m_n = 0.5^(1/n) and m_1 = 1 - m_n (the positions of a normal probability plot)."""
    from ripplet.functions.special import normal_quantile_sql
    res = residual_table(preds, split, keys)
    w = Window.partitionBy(*keys).orderBy("e", "date")
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys)).cast("double")
    i = F.row_number().over(w).cast("double")
    last = F.pow(F.lit(0.5), 1.0 / n)
    pp = (F.when(i == n, last).when(i == 1, 1.0 - last)
           .otherwise((i - FILLIBEN_A) / (n + FILLIBEN_B)))
    pts = res.select(*keys, i.cast("int").alias("i"), F.col("e").alias("sample"), pp.alias("pp"))
    return pts.select(*keys, "i", "pp", F.expr(normal_quantile_sql("pp")).alias("theoretical"), "sample")


def residuals_vs_prediction(preds: DataFrame, split: str = "test") -> DataFrame:
    """Residual against prediction (the scatter behind the plot)."""
    return (preds.where(F.col("split") == split)
                 .select("symbol", "model", "date", "y_pred", (F.col("y_true") - F.col("y_pred")).alias("e")))


