"""Model families: closed forms, the patience rule, and what the pipeline scales by."""
import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ripplet.operators import models as MD


@pytest.fixture(scope="module")
def panel(spark):
    rng = np.random.default_rng(7)
    n = 600
    x = rng.normal(size=(n, 3)) * [1.0, 5.0, 0.1] + [0, 2, 1]
    vol = 0.3 + 0.2 * x[:, 0] ** 2 + 0.05 * x[:, 1] + 0.1 * rng.normal(size=n)
    regime = (vol + 0.2 * rng.normal(size=n) > np.median(vol)).astype(int)
    split = np.where(np.arange(n) < 400, "train", np.where(np.arange(n) < 500, "val", "test"))
    rows = [("s", i, str(split[i]), *map(float, x[i]), float(vol[i]), int(regime[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "symbol string, date int, split string, f0 double, f1 double, f2 double, target_vol double, target_regime int").cache()
    old = MD.FEATURE_COLUMNS
    MD.fit_preprocessing.__defaults__ = (["f0", "f1", "f2"],)
    MD.fit_pipeline.__defaults__ = (["f0", "f1", "f2"],)
    yield df
    MD.fit_preprocessing.__defaults__ = (old,)
    MD.fit_pipeline.__defaults__ = (old,)


def design(panel):
    pdf = panel.toPandas()
    tr = pdf[pdf.split == "train"]
    x = tr[["f0", "f1", "f2"]].to_numpy()
    return (x - x.mean(axis=0)) / x.std(axis=0), tr


def test_scaling_uses_the_population_std(panel):
    z, tr = design(panel)
    got = MD.fit_preprocessing(panel.where("split = 'train'")).transform(panel.where("split = 'train'")).select("date", vector_to_array("features").alias("v"))
    got = np.array([r.v for r in got.orderBy("date").collect()])
    np.testing.assert_allclose(got, z, rtol=1e-10, atol=1e-10)


def test_ridge_closed_form(panel):
    z, tr = design(panel)
    y = tr.target_vol.to_numpy()
    beta = np.linalg.solve(z.T @ z + np.eye(3), z.T @ (y - y.mean()))
    train = panel.where("split = 'train'")
    model = MD.fit_pipeline(MD.regression_estimators(train)["ridge"], train)
    np.testing.assert_allclose(model.stages[-1].coefficients.toArray(), beta, rtol=1e-6)


def test_lasso_optimality(panel):
    z, tr = design(panel)
    y = tr.target_vol.to_numpy()
    train = panel.where("split = 'train'")
    m = MD.fit_pipeline(MD.regression_estimators(train)["lasso"], train).stages[-1]
    w = m.coefficients.toArray()
    grad = z.T @ (y - z @ w - m.intercept) / len(y)  # at the optimum within alpha of 0, and alpha * sign where w is not 0
    alpha = 1e-3
    assert (np.abs(grad) <= alpha * 1.05).all()
    np.testing.assert_allclose(grad[w != 0], alpha * np.sign(w[w != 0]), rtol=0.05, atol=1e-5)


def test_logistic_l2_optimality(panel):
    z, tr = design(panel)
    y = tr.target_regime.to_numpy()
    train = panel.where("split = 'train'")
    m = MD.fit_pipeline(MD.classification_estimators(train)["logreg_l2"], train).stages[-1]
    assert isinstance(MD.classification_estimators(train)["logreg_l2"], LogisticRegression)
    w = m.coefficients.toArray()
    p = 1 / (1 + np.exp(-(z @ w + m.intercept)))
    np.testing.assert_allclose(z.T @ (y - p) - w, 0, atol=0.05)


def test_patience_rule():
    assert MD.early_stop_rounds([5, 4, 3, 4, 4, 4], 3) == 3
    assert MD.early_stop_rounds([5, 4, 4.5, 4.4, 3], 3) == 5
    assert MD.early_stop_rounds([5, 4, 4.5, 4.4, 4.3, 3], 3) == 2
    assert MD.early_stop_rounds([3, 2, 1], 30) == 3


