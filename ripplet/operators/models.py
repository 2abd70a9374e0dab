"""Supervised models with Spark ML.

One pooled model per family is fitted on the train rows of the whole panel
(every symbol, distributed fit); pre-processing is fitted on train only and
applied everywhere, exactly like a scikit-learn Pipeline.  Hyper-parameters
mirror the reference; where Spark's parametrisation differs the mapping is
explicit below.

Mapping notes
* Ridge alpha: Spark minimises 1/(2n) RSS + lambda/2 ||w||^2 on an internally
  standardised label, so lambda = alpha * sigma_y / n (sigma_y population std).
* Lasso alpha maps to regParam directly (elasticNetParam = 1).
* LogReg / LinearSVC C: regParam = 1 / (C * n).
* Boosted trees (F13-F15): ``ripplet.operators.boosting``; Spark ML's have no L2 leaf penalty, no column sampling per
  tree, and cannot go on from a fitted ensemble.
* Scaling uses the population standard deviation.  Medians of the pooled
  pipeline come from Spark's bounded quantile sketch (rank error 0.1 %).
"""

from __future__ import annotations

import math
import time

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, LinearSVC, LogisticRegression, NaiveBayes,
                                       RandomForestClassifier)
from pyspark.ml.feature import ElementwiseProduct, Imputer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression, RandomForestRegressor
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ripplet.operators.boosting import BoostedModel, early_stop_rounds, fit_boosted  # noqa: F401
from ripplet.operators.features import FEATURE_COLUMNS

SEED = 42
# Per-task histogram memory for tree growing: only changes how many nodes are
# split per pass (not the result); small enough for many concurrent tasks.
TREE_MEM_MB = 32


def fit_preprocessing(train: DataFrame, features: list[str] = FEATURE_COLUMNS) -> PipelineModel:
    """F1 + F2 fitted on the training rows: median imputation, then scaling by mean and population std."""
    features = list(features)
    imp = [f"{c}__imp" for c in features]
    n = train.count()
    population = math.sqrt(n / (n - 1)) if n > 1 else 1.0  # Spark scales by the sample std
    return Pipeline(stages=[
        Imputer(inputCols=features, outputCols=imp, strategy="median", relativeError=0.001),
        VectorAssembler(inputCols=imp, outputCol="_raw", handleInvalid="keep"),
        StandardScaler(inputCol="_raw", outputCol="_scaled", withMean=True, withStd=True),
        ElementwiseProduct(inputCol="_scaled", outputCol="features", scalingVec=Vectors.dense([population] * len(features)))]).fit(train)


def fit_pipeline(estimator, train: DataFrame, features: list[str] = FEATURE_COLUMNS) -> PipelineModel:
    """imputer + scaler + model, all fitted on ``train``."""
    prep = fit_preprocessing(train, features)
    return PipelineModel(stages=[*prep.stages, estimator.fit(prep.transform(train))])


def _n_and_sigma(train: DataFrame, label: str) -> tuple[int, float]:
    r = train.agg(F.count(label).alias("n"), F.stddev_pop(label).alias("s")).first()
    return int(r["n"]), float(r["s"] or 1.0)


def regression_estimators(train: DataFrame, label: str = "target_vol") -> dict:
    n, sy = _n_and_sigma(train, label)
    common = dict(featuresCol="features", labelCol=label, predictionCol="prediction")
    return {
        "ridge": LinearRegression(elasticNetParam=0.0, regParam=1.0 * sy / n, standardization=False,
                                  solver="normal", **common),                                   # F4
        "lasso": LinearRegression(elasticNetParam=1.0, regParam=1e-3, standardization=False,
                                  maxIter=1000, tol=1e-10, **common),                           # F5
        "tree": DecisionTreeRegressor(maxDepth=8, minInstancesPerNode=10, maxBins=256, seed=SEED,
                                      maxMemoryInMB=TREE_MEM_MB, **common),  # F7
        "rf": RandomForestRegressor(numTrees=200, maxDepth=10, minInstancesPerNode=5, maxBins=256,
                                    featureSubsetStrategy="sqrt", seed=SEED, maxMemoryInMB=TREE_MEM_MB, **common),           # F8
    }


def classification_estimators(train: DataFrame, label: str = "target_regime") -> dict:
    n = train.where(F.col(label).isNotNull()).count()
    common = dict(featuresCol="features", labelCol=label)
    return {
        "logreg_l1": LogisticRegression(elasticNetParam=1.0, regParam=1.0 / n, standardization=False,
                                        maxIter=500, **common),                                  # F12
        "logreg_l2": LogisticRegression(elasticNetParam=0.0, regParam=1.0 / n, standardization=False,
                                        maxIter=500, **common),
        "tree": DecisionTreeClassifier(maxDepth=8, minInstancesPerNode=10, maxBins=256, seed=SEED,
                                       maxMemoryInMB=TREE_MEM_MB, **common),
        "rf": RandomForestClassifier(numTrees=200, maxDepth=10, minInstancesPerNode=5, maxBins=256,
                                     featureSubsetStrategy="sqrt", seed=SEED, maxMemoryInMB=TREE_MEM_MB, **common),
        "gaussian_nb": NaiveBayes(modelType="gaussian", **common),                               # F11
        "linear_svc": LinearSVC(regParam=1.0 / n, standardization=False, maxIter=500, **common),  # F17
    }


def fit_gbt(panel: DataFrame, task: str, label: str, features: list[str] | None = None, **spec) -> BoostedModel:
    """Boosted trees on the train split, stopped by the patience rule on the val split."""
    return fit_boosted(panel, features or FEATURE_COLUMNS, task, label, F.col("split") == "train", F.col("split") == "val", **spec)


def predictions_long(model: PipelineModel | BoostedModel, panel: DataFrame, name: str, task: str, label: str) -> DataFrame:
    """Apply a fitted pipeline to every row; long form with a clip at 0 for regression."""
    out = model.transform(panel)
    keys = [F.col("symbol"), F.col("date"), F.col("split"), F.lit(name).alias("model")]
    if task == "regression":
        pred = F.col("prediction")
        return out.select(*keys, F.col(label).alias("y_true"),
                          F.when(pred.isNotNull(), F.greatest(pred, F.lit(0.0))).alias("y_pred"))
    if isinstance(model, BoostedModel):
        score = F.col("score")
    else:
        score = vector_to_array("probability" if "probability" in out.columns else "rawPrediction")[1]
    return out.select(*keys, F.col(label).alias("label"), score.alias("score"),
                      F.col("prediction").cast("int").alias("pred"))


def fit_and_evaluate(panel: DataFrame, estimators: dict, task: str, label: str) -> tuple[DataFrame, DataFrame]:
    """preprocessing fitted once on train, each model fitted (and timed) on the prepared rows; returns
    (long predictions of every split, fit log with seconds per model)."""
    spark = panel.sparkSession
    prep = fit_preprocessing(panel.where(F.col("split") == "train"))
    ready = prep.transform(panel).select("symbol", "date", "split", label, "features").persist(StorageLevel.MEMORY_AND_DISK)
    preds, log = None, []
    for name, est in estimators.items():
        t0 = time.perf_counter()
        model = est.fit(ready.where((F.col("split") == "train") & F.col(label).isNotNull()))
        log.append((name, time.perf_counter() - t0))
        p = predictions_long(PipelineModel(stages=[*prep.stages, model]), panel, name, task, label)
        preds = p if preds is None else preds.unionByName(p)
    ready.unpersist()
    fit_log = spark.createDataFrame(log, "model string, fit_sec double")
    return preds, fit_log


def platt_calibrated_svc(panel: DataFrame, label: str = "target_regime", folds: int = 3) -> DataFrame:
    """F16: LinearSVC + sigmoid (Platt) calibration, cv = 3, averaged.

    Per fold f (contiguous thirds of each symbol's train rows, no shuffle):
    fit the SVC on the other folds, fit a 1-feature logistic regression of the
    label on the SVC margin over fold f; the final probability averages the
    three calibrated models.  Returns long classification predictions."""
    from pyspark.sql import Window
    train = panel.where(F.col("split") == "train")
    w = Window.partitionBy("symbol").orderBy("date")
    n = F.count(F.lit(1)).over(Window.partitionBy("symbol"))
    train = train.withColumn("_fold", F.floor((F.row_number().over(w) - 1) * folds / n).cast("int"))
    n_train = train.count()
    probs = None
    for f in range(folds):
        svc = LinearSVC(featuresCol="features", labelCol=label, regParam=1.0 / n_train,
                        standardization=False, maxIter=500)
        m = fit_pipeline(svc, train.where(F.col("_fold") != f))
        cal_in = m.transform(train.where(F.col("_fold") == f)) \
                  .withColumn("_margin", vector_to_array("rawPrediction")[1])
        cal = Pipeline(stages=[VectorAssembler(inputCols=["_margin"], outputCol="_mv"),
                               LogisticRegression(featuresCol="_mv", labelCol=label, regParam=0.0,
                                                  probabilityCol="_cp", rawPredictionCol="_cr",
                                                  predictionCol="_cpred")]).fit(cal_in)
        out = cal.transform(m.transform(panel).withColumn("_margin", vector_to_array("rawPrediction")[1]))
        p = out.select("symbol", "date", vector_to_array("_cp")[1].alias(f"_p{f}"))
        probs = p if probs is None else probs.join(p, ["symbol", "date"])
    score = sum(F.col(f"_p{f}") for f in range(folds)) / float(folds)
    base = panel.select("symbol", "date", "split", F.col(label).alias("label"))
    return base.join(probs, ["symbol", "date"]).select(
        "symbol", "date", "split", F.lit("linear_svc_platt").alias("model"), "label",
        score.alias("score"), (score > 0.5).cast("int").alias("pred"))
