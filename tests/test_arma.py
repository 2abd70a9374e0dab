"""With one epoch the periodic refit equals the train-fitted filter; refits only move later rows."""
import numpy as np
from pyspark.sql import functions as F

from ripplet.operators import arma_garch as AG
from ripplet.plans.panel import modelling_table


def test_refit_single_epoch_equals_plain(bars):
    p = modelling_table(bars).cache()
    a = AG.arma11_forecast(p).select("symbol", "date", F.col("y_pred").alias("a"))
    b = AG.arma11_refit_forecast(p, refit_every=10 ** 6).select("symbol", "date", F.col("y_pred").alias("b"))
    j = a.join(b, ["symbol", "date"])
    assert j.count() == p.count()
    assert j.agg(F.max(F.abs(F.col("a") - F.col("b")))).first()[0] < 1e-12
    c = AG.arma11_refit_forecast(p, refit_every=50).select("symbol", "date", "split", F.col("y_pred").alias("c"))
    k = c.join(a, ["symbol", "date"]).where(F.col("split") == "train")
    assert k.agg(F.max(F.abs(F.col("a") - F.col("c")))).first()[0] < 1e-12


def simulate(phi, theta, n, seed, mu=2.0):
    rng = np.random.default_rng(seed)
    e = rng.normal(size=n + 200)
    x = np.zeros(n + 200)
    for t in range(1, n + 200):
        x[t] = phi * x[t - 1] + e[t] + theta * e[t - 1]
    return mu + x[200:]


def dense_loglik(y, phi, theta):
    """The same likelihood from the covariance matrix, mean and variance at their best."""
    n = len(y)
    g = np.empty(n)
    g[0] = (1 + 2 * phi * theta + theta ** 2) / (1 - phi ** 2)
    g[1] = phi * g[0] + theta
    for k in range(2, n):
        g[k] = phi * g[k - 1]
    cov = g[np.abs(np.subtract.outer(np.arange(n), np.arange(n)))]
    inv, one = np.linalg.inv(cov), np.ones(n)
    mu = one @ inv @ y / (one @ inv @ one)
    s2 = (y - mu) @ inv @ (y - mu) / n
    return -0.5 * n * (np.log(2 * np.pi * s2) + 1) - 0.5 * np.linalg.slogdet(cov)[1], mu, s2


def test_exact_likelihood_equals_the_dense_one(spark):
    y = simulate(0.7, -0.4, 60, 3)
    tr = spark.createDataFrame([("s", i, float(v), i) for i, v in enumerate(y)], "symbol string, date int, _y double, _pos int")
    cands = [(0.7, -0.4), (0.0, 0.0), (0.95, 0.9), (-0.5, 0.3), (0.3, -0.99)]
    got = AG.arma11_loglik(tr, spark.createDataFrame([("s", i, a, b) for i, (a, b) in enumerate(cands)], "symbol string, cand int, phi double, theta double"))
    for r in got.collect():
        np.testing.assert_allclose((r.loglik, r.mu, r.sigma2), dense_loglik(y, *cands[r.cand]), rtol=1e-8)


def test_mle_recovers_known_parameters_and_never_loses_to_its_start(spark):
    true = {"a": (0.8, -0.3), "b": (0.3, 0.5), "c": (-0.6, 0.2)}
    rows = [(s, i, float(v), "train") for k, (s, (p, t)) in enumerate(true.items()) for i, v in enumerate(simulate(p, t, 3000, k))]
    fit = AG.arma11_mle(spark.createDataFrame(rows, "symbol string, date int, vol_realized double, split string"), rounds=4).collect()
    assert len(fit) == 3
    for r in fit:
        assert abs(r.phi - true[r.symbol][0]) < 0.08 and abs(r.theta - true[r.symbol][1]) < 0.08
        assert abs(r.c / (1 - r.phi) - 2.0) < 0.3 and r.loglik >= r.loglik_start - 1e-9
