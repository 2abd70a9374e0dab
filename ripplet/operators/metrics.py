"""Metrics (I1-I6) over long prediction tables, one aggregation per family.

Regression: (keys..., y_true, y_pred).  Classification: (keys..., label,
score, pred).  AUC is exact (Mann-Whitney with ties = 1/2) from per-score
counts: rows are first collapsed to distinct scores (map-side combine), so the
per-group ordered window only sees distinct scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEYS = ("symbol", "model", "split")


def regression_metrics(preds: DataFrame, keys=KEYS) -> DataFrame:
    """RMSE, MAE, R^2 (SST about the mean of the same group) and n."""
    e = F.col("y_pred") - F.col("y_true")
    ok = preds.where(F.col("y_pred").isNotNull() & F.col("y_true").isNotNull())
    return (ok.groupBy(*keys)
              .agg(F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
                   (F.lit(1.0) - F.try_divide(F.sum(e * e), F.var_pop("y_true") * F.count(F.lit(1))))
                   .alias("r2"),
                   F.count(F.lit(1)).alias("n")))


def classification_metrics(df: DataFrame, keys=KEYS, label: str = "label",
                           pred: str = "pred") -> DataFrame:
    """Accuracy, precision, recall, F1 (zero division -> 0)."""
    y, p = F.col(label), F.col(pred)
    tp = F.sum(F.when((y == 1) & (p == 1), 1).otherwise(0))
    fp = F.sum(F.when((y == 0) & (p == 1), 1).otherwise(0))
    fn = F.sum(F.when((y == 1) & (p == 0), 1).otherwise(0))
    agg = df.where(y.isNotNull() & p.isNotNull()).groupBy(*keys).agg(
        F.avg((y == p).cast("double")).alias("accuracy"),
        tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), F.count(F.lit(1)).alias("n"))
    prec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fp")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fn")), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2.0 * F.col("tp").cast("double"),
                                 2 * F.col("tp") + F.col("fp") + F.col("fn")), F.lit(0.0))
    return agg.select(*keys, "accuracy", prec.alias("precision"), rec.alias("recall"),
                      f1.alias("f1"), "n")


def score_counts(df: DataFrame, keys=KEYS, label: str = "label", score: str = "score") -> DataFrame:
    return (df.where(F.col(label).isNotNull() & F.col(score).isNotNull())
              .groupBy(*keys, score)
              .agg(F.sum(F.col(label).cast("long")).alias("pos"),
                   F.sum((1 - F.col(label)).cast("long")).alias("neg")))


def roc_auc(df: DataFrame, keys=KEYS, label: str = "label", score: str = "score") -> DataFrame:
    """Exact ROC AUC; ties count 1/2; NULL when one class is absent."""
    c = score_counts(df, keys, label, score)
    w = Window.partitionBy(*keys).orderBy(score).rowsBetween(Window.unboundedPreceding, -1)
    c = c.withColumn("_neg_below", F.coalesce(F.sum("neg").over(w), F.lit(0)))
    agg = c.groupBy(*keys).agg(
        F.sum(F.col("pos") * (F.col("_neg_below") + 0.5 * F.col("neg"))).alias("_u"),
        F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
    return agg.select(*keys, F.try_divide(F.col("_u"), (F.col("n_pos") * F.col("n_neg")).cast("double"))
                      .alias("auc"), "n_pos", "n_neg")


def roc_curve(df: DataFrame, keys=KEYS, label: str = "label", score: str = "score") -> DataFrame:
    """I4: (threshold, fpr, tpr) for every distinct score, descending."""
    c = score_counts(df, keys, label, score)
    w = Window.partitionBy(*keys).orderBy(F.col(score).desc()).rowsBetween(Window.unboundedPreceding, 0)
    tot = Window.partitionBy(*keys)
    return c.select(*keys, F.col(score).alias("threshold"),
                    F.try_divide(F.sum("neg").over(w).cast("double"), F.sum("neg").over(tot)).alias("fpr"),
                    F.try_divide(F.sum("pos").over(w).cast("double"), F.sum("pos").over(tot)).alias("tpr"))


def confusion_matrix(df: DataFrame, keys=KEYS, label: str = "label", pred: str = "pred") -> DataFrame:
    """Counts per (true, predicted) cell."""
    return (df.where(F.col(label).isNotNull() & F.col(pred).isNotNull())
              .groupBy(*keys, F.col(label).alias("y_true"), F.col(pred).alias("y_pred"))
              .agg(F.count(F.lit(1)).alias("n")))


def leaderboard(metrics: DataFrame, metric: str = "rmse", ascending: bool = True,
                group=("symbol", "split"), top_k: int | None = None) -> DataFrame:
    """Rank models per group by a metric (ties broken by model name)."""
    o = F.col(metric).asc() if ascending else F.col(metric).desc()
    w = Window.partitionBy(*group).orderBy(o, F.col("model"))
    out = metrics.withColumn("rank", F.row_number().over(w))
    return out.where(F.col("rank") <= top_k) if top_k else out


def val_test_gap(metrics: DataFrame, metric: str = "rmse") -> DataFrame:
    """Metric on test minus metric on val per (symbol, model)."""
    g = metrics.groupBy("symbol", "model").agg(
        F.max(F.when(F.col("split") == "val", F.col(metric))).alias(f"{metric}_val"),
        F.max(F.when(F.col("split") == "test", F.col(metric))).alias(f"{metric}_test"))
    return g.withColumn("gap", F.col(f"{metric}_test") - F.col(f"{metric}_val"))


def master_table(regression: DataFrame, classification: DataFrame) -> DataFrame:
    """Union of result families (NULL where a metric does not apply),
    ranked inside each (family, symbol, split) by its primary metric."""
    reg = regression.select(F.lit("forecast").alias("family"), "symbol", "split", "model", "rmse", "mae")
    cls = classification.select(F.lit("regime").alias("family"), "symbol", "split", "model", "auc")
    u = reg.unionByName(cls, allowMissingColumns=True)
    primary = F.when(F.col("family") == "forecast", F.col("rmse")).otherwise(-F.col("auc"))
    w = Window.partitionBy("family", "symbol", "split").orderBy(primary, F.col("model"))
    return u.withColumn("rank", F.row_number().over(w))


def regime_scores_wide(wide, models) -> "DataFrame":
    """Classification view straight from the wide forecast table (label and
    threshold are already on the row, so no join back to the panel)."""
    base = wide.select("symbol", "date", "split", F.col("target_regime").alias("label"), "regime_threshold",
                       *[F.col(m).cast("double") for m in models])
    long = base.unpivot(["symbol", "date", "split", "label", "regime_threshold"], list(models), "model", "score")
    return long.select("symbol", "date", "split", "model", "label", "score",
                       F.when(F.col("score").isNotNull(),
                              (F.col("score") > F.col("regime_threshold")).cast("int")).alias("pred"))
