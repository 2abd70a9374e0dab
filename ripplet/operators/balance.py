"""Class balancing.

Weights (G3, G4) are per-group aggregates turned into a ``weightCol``;
undersampling (G5) ranks rows by a deterministic hash inside each group, so
the sample is exact in size and independent of partitioning; SMOTE / ADASYN
(G1, G2) are built on the exact kNN join of ``ripplet.operators.knn``.  G6 puts
them inside model fits: resampling changes training rows only."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Estimator
from pyspark.ml.classification import DecisionTreeClassifier, LinearSVC, LogisticRegression, NaiveBayes, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ripplet.functions.random import hash60_sql
from ripplet.operators.boosting import Spec, bin_table, fit_boosted_many
from ripplet.operators.features import FEATURE_COLUMNS
from ripplet.operators.knn import adasyn, knn_predict, smote
from ripplet.operators.metrics import classification_metrics, roc_auc
from ripplet.operators.models import fit_preprocessing
from ripplet.session import materialize


def class_weights(df: DataFrame, label: str = "label", keys=("symbol",)) -> DataFrame:
    """Balanced weight n / (2 * n_c) per (keys, class)."""
    n = F.sum("n_c").over(Window.partitionBy(*keys))
    c = df.where(F.col(label).isNotNull()).groupBy(*keys, F.col(label).alias("class")) \
          .agg(F.count(F.lit(1)).alias("n_c"))
    return c.withColumn("weight", n.cast("double") / (2.0 * F.col("n_c")))


def scale_pos_weight(df: DataFrame, label: str = "label", keys=("symbol",)) -> DataFrame:
    """Neg / max(pos, 1) per group."""
    y = F.col(label)
    return df.where(y.isNotNull()).groupBy(*keys).agg(
        F.count_if(y == 1).alias("n_pos"), F.count_if(y == 0).alias("n_neg")) \
        .withColumn("scale_pos_weight", F.col("n_neg").cast("double") / F.greatest(F.col("n_pos"), F.lit(1)))


def add_weight_col(df: DataFrame, label: str = "label", keys=("symbol",), mode: str = "balanced") -> DataFrame:
    """Attach ``weight``: balanced (G3) or positive-class scale."""
    if mode == "balanced":
        w = class_weights(df, label, keys).select(*keys, F.col("class").alias(label), "weight")
        return df.join(w, [*keys, label], "left")  # 2 rows per group
    s = scale_pos_weight(df, label, keys).select(*keys, "scale_pos_weight")
    return df.join(s, list(keys), "left") \
             .withColumn("weight", F.when(F.col(label) == 1, F.col("scale_pos_weight")).otherwise(1.0)) \
             .drop("scale_pos_weight")


def undersample_positives(df: DataFrame, id_col: str, label: str = "label", target_pos: float = 0.10,
                          seed: int = 42, keys=("symbol",)) -> DataFrame:
    """Keep every negative and round(n0 * p / (1 - p)) positives, chosen
    by the order of a hash of (seed, id): exact count, reproducible."""
    y = F.col(label)
    wk = Window.partitionBy(*keys)
    h = F.expr(hash60_sql(str(seed), id_col, "0"))
    d = df.where(y.isNotNull()).withColumns({"_h": h, "_id": F.expr(id_col),
                                             "_n0": F.count_if(y == 0).over(wk)})
    w = Window.partitionBy(*keys, label).orderBy("_h", "_id")
    d = d.withColumn("_r", F.row_number().over(w))
    keep = (y == 0) | (F.col("_r") <= F.round(F.col("_n0") * F.lit(target_pos / (1.0 - target_pos))))
    return d.where(keep).drop("_h", "_id", "_n0", "_r")


class Resampled(Estimator):
    """An estimator stage that is fitted on resampled rows.  ``fit`` changes the training rows only (SMOTE, ADASYN, class
    weights or none); the model it returns is the inner estimator's, so scoring never resamples.  Goes last in a Pipeline
    whose earlier stages make the ``features`` vector; ``id_col`` names a long that tells the rows apart."""

    def __init__(self, estimator, technique: str, label: str, id_col: str, k: int = 5, seed: int = 42):
        super().__init__()
        self.estimator, self.technique, self.label, self.id_col, self.k, self.seed = estimator, technique, label, id_col, k, seed

    def _fit(self, dataset: DataFrame):
        rows = resample(dataset, self.technique, self.label, self.id_col, self.k, self.seed)
        estimator = self.estimator.copy({self.estimator.weightCol: "weight"}) if self.technique == "class_weight" else self.estimator
        return estimator.fit(rows)


def resample(rows: DataFrame, technique: str, label: str, id_col: str, k: int = 5, seed: int = 42) -> DataFrame:
    """(id_col, label, features, weight) of the training rows under a technique; ``features`` is a vector column."""
    if technique not in ("none", "smote", "adasyn", "class_weight"):
        raise ValueError(f"unknown technique {technique!r}")
    base = rows.where(F.col(label).isNotNull()).select(F.col(id_col).cast("long").alias(id_col), F.col(label).cast("int").alias(label),
                                                       vector_to_array("features").alias("x"))
    out = base.withColumn("weight", F.lit(1.0))
    if technique == "class_weight":
        counts = {r[label]: r["count"] for r in base.groupBy(label).count().collect()}  # two rows
        n = sum(counts.values())
        out = base.withColumn("weight", F.element_at(F.create_map(*[F.lit(x) for c, m in counts.items() for x in (c, n / (len(counts) * m))]), F.col(label)))
    elif technique != "none":
        base = materialize(base, "resample-base")
        made = (smote if technique == "smote" else adasyn)(base, k, seed, id_col, "x", label)
        if "x" in made.columns:  # ADASYN may not apply
            made = made.select(F.lit(None).cast("long").alias(id_col), F.col(label).cast("int").alias(label), F.col("x").cast("array<double>").alias("x"))
            out = base.unionByName(made).withColumn("weight", F.lit(1.0))
    return out.select(id_col, label, array_to_vector("x").alias("features"), "weight")


def balanced_models(n: int, label: str) -> dict:
    """The classifiers of the model x technique matrix that are Spark ML estimators."""
    kw = dict(featuresCol="features", labelCol=label)
    return {"gaussian_nb": NaiveBayes(modelType="gaussian", **kw),
            "logreg_l1": LogisticRegression(elasticNetParam=1.0, regParam=1.0 / n, standardization=False, maxIter=500, **kw),
            "logreg_l2": LogisticRegression(elasticNetParam=0.0, regParam=1.0 / n, standardization=False, maxIter=500, **kw),
            "tree": DecisionTreeClassifier(maxDepth=8, minInstancesPerNode=10, maxBins=256, seed=42, **kw),
            "rf": RandomForestClassifier(numTrees=200, maxDepth=10, minInstancesPerNode=5, maxBins=256, featureSubsetStrategy="sqrt", seed=42, **kw),
            "linear_svc": LinearSVC(regParam=1.0 / n, standardization=False, maxIter=500, **kw)}


def balancing_experiment(panel: DataFrame, label: str = "target_regime", features: list[str] | None = None, positives: float = 0.10) -> DataFrame:
    """Eight models x techniques on the regime task; long (model, technique, symbol, auc, f1) on the test split.

    ``none`` fits on all train rows; the others on train rows undersampled to ``positives`` (G5): ``undersample`` as they are,
    ``class_weight``, ``smote`` and ``adasyn`` balanced again.  Every technique's training rows are made and written once; models
    that Spark fits alone are fitted a few at a time.  kNN takes no weights."""
    features = list(features or FEATURE_COLUMNS)
    train = panel.where(F.col("split") == "train")
    prep = fit_preprocessing(train, features)
    ready = prep.transform(panel).withColumn("row_id", F.xxhash64("symbol", "date"))
    ready = materialize(ready.select("symbol", "date", "split", label, "features", "row_id"), "balance-rows")
    test, full = ready.where("split = 'test'"), ready.where("split = 'train'").where(F.col(label).isNotNull())
    few = undersample_positives(full.withColumnRenamed(label, "_lab"), "unix_date(date)", "_lab", positives).withColumnRenamed("_lab", label)
    few = materialize(few, "balance-few")
    sets = {"none": (full, "none"), "undersample": (few, "none"), "class_weight": (few, "class_weight"), "smote": (few, "smote"), "adasyn": (few, "adasyn")}
    parts = max(1, -(-full.count() // 50_000))  # fits are chains of short jobs: no more tasks than the rows ask for
    data = {t: materialize(resample(rows, how, label, "row_id").repartition(parts), f"balance-{t}") for t, (rows, how) in sets.items()}
    sizes = {t: d.count() for t, d in data.items()}

    def fitted(job):
        tech, name = job
        est = balanced_models(sizes[tech], label)[name]
        if tech == "class_weight":
            est = est.copy({est.weightCol: "weight"})
        return tech, name, est.fit(data[tech])

    jobs = [(t, m) for t in data for m in balanced_models(1, label)]
    with ThreadPoolExecutor(max_workers=8) as pool:
        models = list(pool.map(fitted, jobs))
    keys = [F.col("symbol"), F.col("split"), F.col(label).alias("label")]
    out = None

    def add(scored: DataFrame, tech: str, name: str, score, pred):
        nonlocal out
        p = scored.select(*keys, F.lit(name).alias("model"), F.lit(tech).alias("technique"), score.cast("double").alias("score"), pred.cast("int").alias("pred"))
        out = p if out is None else out.unionByName(p)

    for tech, name, model in models:
        scored = model.transform(test)
        add(scored, tech, name, vector_to_array("probability" if "probability" in scored.columns else "rawPrediction")[1], F.col("prediction"))
    # boosted trees of all techniques in one run; kNN by its join
    wide = {t: d.select(F.monotonically_increasing_id().alias("_key"), F.lit(t).alias("_tech"), F.col(label), vector_to_array("features").alias("x")) for t, d in data.items() if t != "class_weight"}
    rows = None
    for t, d in wide.items():
        rows = d if rows is None else rows.unionByName(d)
    val = ready.where("split = 'val'").select(F.col("row_id").alias("_key"), F.lit("val").alias("_tech"), F.col(label), vector_to_array("features").alias("x"))
    rows = materialize(rows.unionByName(val).select("_key", "_tech", label, *[F.col("x")[i].alias(c) for i, c in enumerate(features)]), "balance-boost")
    table = bin_table(rows, features, [label], [(F.col("_tech") == t, F.col("_tech") == "val") for t in wide], ["_tech", "_key"])
    weight = {r[label]: r["count"] for r in few.groupBy(label).count().collect()}
    order = list(wide)
    specs = [Spec("classification", fold=i) for i in range(len(order))]
    specs.append(Spec("classification", fold=order.index("undersample"), pos_weight=weight.get(0, 1) / max(weight.get(1, 1), 1)))
    flat = test.select("*", vector_to_array("features").alias("x")).select("*", *[F.col("x")[i].alias(c) for i, c in enumerate(features)])
    for tech, model in zip([*order, "class_weight"], fit_boosted_many(table, specs)):
        add(model.transform(flat), tech, "gbt", F.col("score"), F.col("prediction"))
    for tech, d in data.items():
        if tech == "class_weight":
            continue
        refs = d.select(F.monotonically_increasing_id().alias("vec_id"), vector_to_array("features").alias("embedding"), F.col(label).alias("label"))
        near = knn_predict(test.where(F.col(label).isNotNull()).select(F.col("row_id").alias("vec_id"), vector_to_array("features").alias("embedding"), F.col(label).alias("label")),
                           materialize(refs, "balance-refs"), k=15).select(F.col("vec_id").alias("row_id"), "pred", "mean_label")
        add(test.join(near, "row_id"), tech, "knn", F.col("mean_label"), F.col("pred"))
    out = materialize(out, "balance-scores")
    group = ("symbol", "model", "technique")
    return roc_auc(out, group).join(classification_metrics(out, group), list(group)).select(*group, "auc", "f1")
