"""One bad series must not end the job: constant, one-class, short and collinear series give NULL."""
import datetime as dt
import math

import numpy as np
from pyspark.sql import functions as F

from ripplet.operators import compare as K
from ripplet.operators import explore as X
from ripplet.operators import residuals as J
from ripplet.operators.bds import bds_residuals
from ripplet.operators.forecast import add_forecasts

DAY = dt.date(2020, 1, 1)


def preds(spark, series):
    rows = [(s, "m", DAY + dt.timedelta(i), "test", float(e), 0.0) for s, values in series.items() for i, e in enumerate(values)]
    return spark.createDataFrame(rows, "symbol string, model string, date date, split string, y_true double, y_pred double")


def series():
    rng = np.random.default_rng(0)
    return {"good": rng.normal(size=80), "flat": [1.0] * 40, "one": [0.3], "two": [0.1, 0.2], "three": [0.1, 0.2, 0.4], "eleven": rng.normal(size=11)}


def test_residual_tests_and_summary(spark):
    p = preds(spark, series())
    out = {(r.symbol, r.test): r.statistic for r in J.residual_tests(p).collect()}
    assert all(out["good", t] is not None for t, _, _ in J.TESTS)
    assert out["flat", "white"] is None and out["flat", "breusch_pagan"] is None and out["flat", "ljung_box(lag=10)"] is None
    assert out["two", "ljung_box(lag=10)"] is None
    assert {r.symbol for r in J.residual_summary(p).collect()} == set(series())
    assert {r.symbol for r in J.residual_acf(p, n_lags=3).where("acf IS NULL").collect()} >= {"flat", "one"}


def test_bds(spark):
    out = {(r.symbol, r.dim): r.statistic for r in bds_residuals(preds(spark, series())).collect()}
    assert out["good", 2] is not None and out["flat", 2] is None and out["one", 2] is None and out["two", 3] is None
    assert not any(v is not None and math.isnan(v) for v in out.values())


def test_moments_and_acf(spark):
    rows = [(s, DAY + dt.timedelta(i), float(v)) for s, values in series().items() for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "symbol string, date date, log_return double")
    out = {r.symbol: r for r in X.return_moments(df).collect()}
    assert out["two"].skew is None and out["three"].kurt is None and out["flat"].skew is None and out["good"].kurt is not None
    assert X.acf(df, "log_return", 3).where("symbol = 'flat' AND acf IS NOT NULL").count() == 0


def wide(spark, n=60):
    rng = np.random.default_rng(1)
    rows = []
    for s in ("ok", "single"):
        y = np.abs(rng.normal(size=n))
        for i in range(n):
            label = int(y[i] > 0.7) if s == "ok" else 1
            rows.append((s, DAY + dt.timedelta(i), float(y[i]), label, float(y[i] + rng.normal() / 3), float(rng.normal()),
                         None if i % 3 else float(rng.normal()), None))
    return spark.createDataFrame(rows, "symbol string, date date, target_vol double, target_regime int, a double, b double, c double, d double")


def naive_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    return np.mean([(p > neg).mean() + (p == neg).mean() / 2 for p in pos])


def test_pairs_are_complete_on_their_own(spark):
    df, models = wide(spark), ["a", "b", "c", "d"]
    pdf = df.where("symbol = 'ok'").toPandas()
    dm = {(r.model_a, r.model_b): r.n for r in K.diebold_mariano(df, models).where("symbol = 'ok'").collect()}
    assert dm["a", "b"] == 60 and dm["a", "c"] == 20 and dm["a", "d"] == 0
    de = {(r.symbol, r.model_a, r.model_b): r for r in K.delong(df, models).collect()}
    assert {k[0] for k in de} == {"ok"} and ("ok", "a", "d") not in de
    both = pdf.dropna(subset=["c"])
    for pair, rows in ((("a", "b"), pdf), (("a", "c"), both)):
        got = de[("ok", *pair)]
        assert abs(got.auc_a - naive_auc(rows.target_regime.to_numpy(), rows[pair[0]].to_numpy())) < 1e-12
        assert abs(got.auc_b - naive_auc(rows.target_regime.to_numpy(), rows[pair[1]].to_numpy())) < 1e-12
    boot = {(r.symbol, r.model): r for r in K.bootstrap_rmse_ci(df, models, n_boot=50).collect()}
    assert set(boot) == {(s, m) for s in ("ok", "single") for m in "abc"}
    assert abs(boot["ok", "c"].rmse - math.sqrt(((both.c - both.target_vol) ** 2).mean())) < 1e-12
    auc = {(r.symbol, r.model): r for r in K.bootstrap_auc_ci(df, models, n_boot=50).collect()}
    assert auc["single", "a"].n_undefined == 50 and auc["single", "a"].ci_lo is None and auc["ok", "a"].n_boot == 50


def test_dm_divides_by_the_number_of_lagged_products(spark):
    df = wide(spark)
    pdf = df.where("symbol = 'ok'").toPandas()
    for pair, loss in ((("a", "b"), "se"), (("a", "c"), "ae")):
        rows = pdf.dropna(subset=list(pair))
        f = (lambda e: e * e) if loss == "se" else abs
        d = (f(rows[pair[0]] - rows.target_vol) - f(rows[pair[1]] - rows.target_vol)).to_numpy()
        c, n = d - d.mean(), len(d)
        var = d.var() + 2 * sum(np.mean(c[k:] * c[:-k]) for k in range(1, 4))
        got = [r for r in K.diebold_mariano(df, ["a", "b", "c"], loss=loss, horizon=4).where("symbol = 'ok'").collect() if (r.model_a, r.model_b) == pair][0]
        assert got.n == n
        assert (got.statistic is None) if var <= 0 else abs(got.statistic - d.mean() / math.sqrt(var / n)) < 1e-9


def test_poisson_bootstrap_is_near_the_multinomial_one(spark):
    df = wide(spark)
    a = {(r.symbol, r.model): r for r in K.bootstrap_rmse_ci(df, ["a", "b"], n_boot=400).collect()}
    b = {(r.symbol, r.model): r for r in K.poisson_bootstrap_rmse_ci(df, ["a", "b"], n_boot=400).collect()}
    for k in a:
        width = a[k].ci_hi - a[k].ci_lo
        assert abs(a[k].ci_lo - b[k].ci_lo) < 0.25 * width and abs(a[k].ci_hi - b[k].ci_hi) < 0.25 * width


def test_variance_tests_match_least_squares(spark):
    rng = np.random.default_rng(5)
    n = 200
    x1, x2 = rng.normal(size=n), rng.normal(size=n)
    e = rng.normal(size=n) * (1 + 0.5 * np.abs(x1))
    rows = [("s", "m", DAY + dt.timedelta(i), "test", float(e[i]), 0.0, float(x1[i]), float(x2[i])) for i in range(n)]
    rows += [("flat", "m", DAY + dt.timedelta(i), "test", 1.0, 0.0, float(i), 1.0) for i in range(10)]
    df = spark.createDataFrame(rows, "symbol string, model string, date date, split string, y_true double, y_pred double, x1 double, x2 double")
    got = {(r.symbol, r.test): r for r in J.variance_tests(df, ["x1", "x2"]).collect()}
    for name, cols in (("white", [x1, x2, x1 * x1, x1 * x2, x2 * x2]), ("breusch_pagan", [x1, x2])):
        A = np.column_stack([np.ones(n), *cols])
        u = e * e
        fit = A @ np.linalg.lstsq(A, u, rcond=None)[0]
        r2 = 1 - ((u - fit) ** 2).sum() / ((u - u.mean()) ** 2).sum()
        assert abs(got["s", name].statistic - n * r2) < 1e-6 and got["s", name].dof == len(cols)
    assert got["flat", "white"].statistic is None and got["flat", "white"].p_value is None


def test_collinear_har_system(spark):
    n = 120
    rows = [("col", DAY + dt.timedelta(i), 0.01 * (i % 5), 0.1, 0.1, 0.1, 0.1 + i * 0.001, "train" if i < 80 else "test") for i in range(n)]
    df = spark.createDataFrame(rows, "symbol string, date date, log_return double, vol_d double, vol_w double, vol_m double, target_vol double, split string")
    df = df.withColumn("vol_realized", F.col("target_vol"))
    out = add_forecasts(df)
    assert out.count() == n and out.where("har_rv IS NOT NULL").count() == 0
