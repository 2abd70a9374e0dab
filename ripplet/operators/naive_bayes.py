"""Gaussian naive Bayes as relational operations.

Vectors are exploded to (id, j, x); the fit is one aggregation per
(class, j) of mergeable sufficient statistics (n, mean, M2), so a
mini-batch / streaming fit that merges statistics equals the full fit
(F19).  Variances are population variances plus sklearn-style smoothing
eps = var_smoothing * max_j var(x_j).  Prediction joins the (classes x dim)
parameter table — bounded by the model, not the data — and takes the
arg-max joint log-likelihood per row."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ripplet.functions.random import uniform_sql


def explode_vectors(df: DataFrame, id_col: str, vec_col: str, extra=()) -> DataFrame:
    return df.select(id_col, *extra, F.posexplode(vec_col).alias("j", "x")) \
             .withColumn("x", F.col("x").cast("double"))


def embeddings_split(df: DataFrame, seed: int = 42, train_frac: float = 0.7) -> DataFrame:
    """Reproducible train/test assignment from a hash of the vector id."""
    u = F.expr(uniform_sql(str(seed), "vec_id", "0"))
    return df.withColumn("split", F.when(u < F.lit(train_frac), "train").otherwise("test"))


def sufficient_stats(long: DataFrame, label: str = "label") -> DataFrame:
    """(class, j) -> n, mean, m2 (sum of squared deviations) — mergeable across batches without cancellation."""
    return long.groupBy(F.col(label).alias("class"), "j").agg(
        F.count("x").alias("n"), F.avg("x").alias("mean"), (F.var_pop("x") * F.count("x")).alias("m2"))


def combine_stats(stats: DataFrame, keys=("class", "j")) -> DataFrame:
    """Merge statistics of several batches (or classes) per key: m2 adds each part's own deviations and those of its
    mean from the common mean."""
    w = Window.partitionBy(*keys)
    s = stats.withColumn("_all", F.sum(F.col("n") * F.col("mean")).over(w) / F.sum("n").over(w))
    return s.groupBy(*keys).agg(F.sum("n").alias("n"), F.first("_all").alias("mean"),
                                F.sum(F.col("m2") + F.col("n") * (F.col("mean") - F.col("_all")) ** 2).alias("m2"))


def merge_stats(a: DataFrame, b: DataFrame) -> DataFrame:
    return combine_stats(a.unionByName(b))


def fit_gnb(long_train: DataFrame, label: str = "label", var_smoothing: float = 1e-9) -> DataFrame:
    """Parameters (class, j, mu, var, log_prior) from the training rows: one pass over the exploded vectors, the rest
    on the (classes x dim) statistics."""
    return gnb_from_stats(sufficient_stats(long_train, label), var_smoothing)


def predict_gnb(long_test: DataFrame, params: DataFrame, id_col: str = "vec_id", label: str = "label") -> DataFrame:
    """Arg-max class of prior + sum_j log N(x_j | mu_cj, var_cj)."""
    two_pi = 2.0 * math.pi
    j = long_test.join(F.broadcast(params), "j")  # classes x dim rows
    ll = -0.5 * F.ln(F.lit(two_pi) * F.col("var")) - 0.5 * (F.col("x") - F.col("mu")) ** 2 / F.col("var")
    per = j.groupBy(id_col, label, "class").agg((F.sum(ll) + F.first("log_prior")).alias("jll"))
    return per.groupBy(id_col, label).agg(F.max_by("class", "jll").alias("pred"))


def gnb_from_stats(stats: DataFrame, var_smoothing: float = 1e-9) -> DataFrame:
    """parameters from merged sufficient statistics."""
    eps = combine_stats(stats, ("j",)).agg((F.max(F.col("m2") / F.col("n")) * F.lit(var_smoothing)).alias("eps"))
    n_all = stats.where(F.col("j") == 0).agg(F.sum("n").alias("n_all"))
    th = stats.crossJoin(F.broadcast(eps)).crossJoin(F.broadcast(n_all))  # single-row scalars
    return th.select("class", "j", F.col("mean").alias("mu"), (F.col("m2") / F.col("n") + F.col("eps")).alias("var"),
                     F.ln(F.col("n") / F.col("n_all")).alias("log_prior"))
