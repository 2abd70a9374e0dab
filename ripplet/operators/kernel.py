"""Kernel machines re-aimed as linear models on random Fourier features
(F9, F10; Rahimi & Recht, 2007).

RBF kernel exp(-gamma ||x - y||^2) ~ z(x).z(y) with z(x) = sqrt(2/D) cos(Wx + b),
W ~ N(0, 2 gamma), b ~ U(0, 2 pi).  gamma = "scale" = 1 / (p * Var(X_train)).
The projection (D x p, a model parameter) is drawn from a fixed seed and
applied per Arrow batch by a pandas UDF (one matrix product per batch).
F9: Huber-loss linear regression on z (epsilon-insensitive loss is not in
Spark ML).  F10: LinearSVC on z with Platt calibration (3 contiguous folds)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ripplet.operators.features import FEATURE_COLUMNS
from ripplet.operators.models import fit_preprocessing


def rff(df: DataFrame, p: int, gamma: float, n_components: int = 200, seed: int = 42,
        in_col: str = "features", out_col: str = "rff") -> DataFrame:
    rng = np.random.default_rng(seed)
    W = rng.normal(0.0, np.sqrt(2.0 * gamma), size=(p, n_components))
    b = rng.uniform(0.0, 2.0 * np.pi, size=n_components)
    scale = np.sqrt(2.0 / n_components)

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def z(col: pd.Series) -> pd.Series:
        X = np.stack(col.to_numpy())
        Z = scale * np.cos(X @ W + b)
        return pd.Series(list(Z))

    return df.withColumn(out_col, array_to_vector(z(vector_to_array(in_col))))


def _gamma_scale(prepped_train: DataFrame, p: int) -> float:
    v = prepped_train.select(F.explode(vector_to_array("features")).alias("x")).agg(F.var_pop("x")).first()[0]
    return 1.0 / (p * (v or 1.0))


def rff_svr(panel: DataFrame, label: str = "target_vol", n_components: int = 200) -> DataFrame:
    """long regression predictions of the RFF + Huber model (clipped at 0)."""
    train = panel.where(F.col("split") == "train")
    prep = fit_preprocessing(train)
    p = len(FEATURE_COLUMNS)
    gamma = _gamma_scale(prep.transform(train), p)
    allz = rff(prep.transform(panel), p, gamma, n_components)
    model = LinearRegression(featuresCol="rff", labelCol=label, loss="huber", regParam=1e-4,
                             maxIter=200).fit(allz.where(F.col("split") == "train"))
    pred = model.transform(allz)
    return pred.select("symbol", "date", "split", F.lit("svr_rff").alias("model"), F.col(label).alias("y_true"),
                       F.greatest(F.col("prediction"), F.lit(0.0)).alias("y_pred"))


def rff_svc(panel: DataFrame, label: str = "target_regime", n_components: int = 200, folds: int = 3) -> DataFrame:
    """LinearSVC on RFF, Platt-calibrated over 3 contiguous train folds, averaged."""
    train = panel.where(F.col("split") == "train")
    prep = fit_preprocessing(train)
    p = len(FEATURE_COLUMNS)
    gamma = _gamma_scale(prep.transform(train), p)
    allz = rff(prep.transform(panel), p, gamma, n_components)
    w = Window.partitionBy("symbol").orderBy("date")
    n = F.count(F.lit(1)).over(Window.partitionBy("symbol"))
    tz = allz.where(F.col("split") == "train") \
             .withColumn("_fold", F.floor((F.row_number().over(w) - 1) * folds / n).cast("int"))
    n_train = tz.count()
    probs = None
    for f in range(folds):
        svc = LinearSVC(featuresCol="rff", labelCol=label, regParam=1.0 / n_train, maxIter=200,
                        standardization=False).fit(tz.where(F.col("_fold") != f))
        cal_in = svc.transform(tz.where(F.col("_fold") == f)).withColumn("_m", vector_to_array("rawPrediction")[1])
        cal = Pipeline(stages=[VectorAssembler(inputCols=["_m"], outputCol="_mv"),
                               LogisticRegression(featuresCol="_mv", labelCol=label, probabilityCol="_cp",
                                                  rawPredictionCol="_cr", predictionCol="_cpred")]).fit(cal_in)
        out = cal.transform(svc.transform(allz).withColumn("_m", vector_to_array("rawPrediction")[1]))
        pr = out.select("symbol", "date", vector_to_array("_cp")[1].alias(f"_p{f}"))
        probs = pr if probs is None else probs.join(pr, ["symbol", "date"])
    score = sum(F.col(f"_p{f}") for f in range(folds)) / float(folds)
    base = panel.select("symbol", "date", "split", F.col(label).alias("label"))
    return base.join(probs, ["symbol", "date"]).select(
        "symbol", "date", "split", F.lit("svc_rff_platt").alias("model"), "label",
        score.alias("score"), (score > 0.5).cast("int").alias("pred"))
