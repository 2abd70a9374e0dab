"""Model explanation as relational jobs.

L1  native tree importance: mean gain, split count and mean cover per feature
    are one groupBy over the model's node table.
L2  permutation importance: every (feature, repeat) permutation is a
    hash-ordered re-pairing of rows (X4), all evaluated in one scoring job;
    importance = RMSE(permuted) - RMSE(original), mean and std over repeats.
L4  representative cases per (symbol, model): exact percentiles of the
    target and max_by / min_by picks.
L6  combined importance: each score clipped at 0, normalised to sum 1 per
    method, averaged across methods, ranked.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ripplet.functions.random import hash60_sql
from ripplet.operators.boosting import BoostedModel


def native_importance(model: BoostedModel, spark) -> DataFrame:
    """L1 from the model's node table: mean gain, split count and mean cover of each feature that splits."""
    split = model.nodes(spark).where("feature IS NOT NULL")
    return split.groupBy("feature").agg(F.avg("gain").alias("gain"), F.count(F.lit(1)).alias("weight"), F.avg("cover").alias("cover"))


def permutation_importance(model, data: DataFrame, features: list[str], label: str,
                           repeats: int = 10, seed: int = 42) -> DataFrame:
    """L2: drop in -RMSE when one feature's values are permuted across rows."""
    # Permutations stay inside each symbol's series (no global single-task ordering).
    w = Window.partitionBy("symbol").orderBy("date")
    base = data.select("symbol", "date", label, *features).withColumn("_pos", F.row_number().over(w) - 1)
    grid = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.lit(r).alias("rep"))
                               for f in features for r in range(repeats)]))
    fi = {f: i for i, f in enumerate(features)}
    e = base.select("*", grid.alias("g")).select("*", "g.feature", "g.rep").drop("g")
    e = e.withColumn("_fidx", F.element_at(F.create_map(*[x for f in features
                                                          for x in (F.lit(f), F.lit(fi[f]))]), F.col("feature")))
    h = F.expr(hash60_sql("rep", "_fidx", "_pos"))
    e = e.withColumn("_k", F.row_number().over(Window.partitionBy("symbol", "feature", "rep").orderBy(h, "_pos")) - 1)
    # Each copy takes one value from its donor row, so the donor side is long and the join carries one column.
    donor = base.select("symbol", F.col("_pos").alias("_k"), *[F.col(f).cast("double").alias(f) for f in features]) \
                .unpivot(["symbol", "_k"], features, "feature", "_value")
    e = e.join(donor, ["symbol", "feature", "_k"])
    e = e.withColumns({f: F.when(F.col("feature") == f, F.col("_value")).otherwise(F.col(f).cast("double")) for f in features})
    err = F.greatest(F.col("prediction"), F.lit(0.0)) - F.col(label)
    perm = model.transform(e).groupBy("feature", "rep").agg(F.sqrt(F.avg(err * err)).alias("rmse"))
    ref = model.transform(base).agg(F.sqrt(F.avg(err * err)).alias("rmse0"))
    return (perm.crossJoin(F.broadcast(ref))   # single-row scalar
                .groupBy("feature").agg(F.avg(F.col("rmse") - F.col("rmse0")).alias("importance_mean"),
                                        F.stddev_pop(F.col("rmse") - F.col("rmse0")).alias("importance_std")))


def representative_cases(preds: DataFrame, split: str = "test", tol: float = 1e-3,
                         keys=("symbol", "model")) -> DataFrame:
    """L4: high-volatility hit, low-volatility hit, worst over- and under-prediction."""
    d = preds.where((F.col("split") == split) & F.col("y_true").isNotNull() & F.col("y_pred").isNotNull())
    wk = Window.partitionBy(*keys)
    d = d.withColumns({"_p90": F.percentile("y_true", F.lit(0.9)).over(wk),
                       "_p10": F.percentile("y_true", F.lit(0.1)).over(wk),
                       "_e": F.col("y_pred") - F.col("y_true")})
    row = F.struct("date", "y_true", "y_pred")
    hit = F.abs(F.col("_e")) < F.lit(tol)
    agg = d.groupBy(*keys).agg(
        F.max_by(F.when((F.col("y_true") > F.col("_p90")) & hit, row),
                 F.when((F.col("y_true") > F.col("_p90")) & hit, F.struct("y_true", "date"))).alias("high_hit"),
        F.min_by(F.when((F.col("y_true") < F.col("_p10")) & hit, row),
                 F.when((F.col("y_true") < F.col("_p10")) & hit, F.struct("y_true", "date"))).alias("low_hit"),
        F.max_by(row, F.struct("_e", "date")).alias("worst_over"),
        F.min_by(row, F.struct("_e", "date")).alias("worst_under"))
    long = agg.unpivot(list(keys), ["high_hit", "low_hit", "worst_over", "worst_under"], "case", "r")
    return long.where(F.col("r").isNotNull()).select(*keys, "case", "r.date", "r.y_true", "r.y_pred")


def combined_importance(scores: DataFrame) -> DataFrame:
    """Scores (method, feature, score) -> clipped, normalised, averaged, ranked."""
    s = scores.withColumn("_c", F.greatest(F.col("score"), F.lit(0.0)))
    tot = F.sum("_c").over(Window.partitionBy("method"))
    s = s.withColumn("_n", F.when(tot > 0, F.col("_c") / tot).otherwise(F.lit(0.0)))
    n_methods = s.select("method").distinct().count()
    comb = s.groupBy("feature").agg((F.sum("_n") / F.lit(float(n_methods))).alias("combined"))
    return comb.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("combined"), "feature")))


def lime(model, train: DataFrame, instances: DataFrame, features: list[str],
         label: str = "target_vol", n_samples: int = 2000, seed: int = 42, top: int = 8,
         alpha: float = 1.0) -> DataFrame:
    """Local surrogate (Ribeiro et al., 2016) for each instance row.

    Quartile-discretised perturbations: for perturbation s > 0 each feature
    draws a quartile bin uniformly and a value uniformly inside the bin
    (training min/quartiles/max); s = 0 is the instance itself.  Binary
    representation z_j = [bin == instance bin]; kernel weight
    sqrt(exp(-d^2 / width^2)), d = ||1 - z||, width = 0.75 sqrt(p).  A weighted
    ridge (alpha, free intercept) of the model output on z per instance gives
    the explanation; the ``top`` largest |weights| are returned."""
    from ripplet.functions.random import uniform_sql
    p = len(features)
    qs = train.agg(*[F.percentile_approx(c, [0.25, 0.5, 0.75], 10000).alias(f"q_{c}") for c in features],
                   *[F.min(c).alias(f"lo_{c}") for c in features], *[F.max(c).alias(f"hi_{c}") for c in features])
    inst = instances.select("symbol", "date", *features).crossJoin(F.broadcast(qs))  # one stats row
    inst = inst.withColumn("inst", F.concat_ws("|", "symbol", F.col("date").cast("string")))

    def bin_of(c):
        q = F.col(f"q_{c}")
        return (F.when(F.col(c) <= q[0], 0).when(F.col(c) <= q[1], 1).when(F.col(c) <= q[2], 2).otherwise(3))

    inst = inst.withColumns({f"_ib{i}": bin_of(c) for i, c in enumerate(features)})
    inst = inst.withColumn("_iid", F.abs(F.xxhash64("inst")) % F.lit(1 << 30))
    pert = inst.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(n_samples - 1))))
    # Draws are separate projections so each hash is evaluated once per row.
    pert = pert.withColumns({f"_u{i}": F.expr(uniform_sql(str(seed + 2 * i), "_iid", "s")) for i in range(p)})
    pert = pert.withColumns({f"_v{i}": F.expr(uniform_sql(str(seed + 2 * i + 1), "_iid", "s")) for i in range(p)})
    pert = pert.withColumns({f"_pb{i}": F.when(F.col("s") == 0, F.col(f"_ib{i}"))
                             .otherwise(F.floor(F.col(f"_u{i}") * 4).cast("int")) for i in range(p)})
    new_cols = {}
    for i, c in enumerate(features):
        b, q = F.col(f"_pb{i}"), F.col(f"q_{c}")
        lo = F.when(b == 0, F.col(f"lo_{c}")).when(b == 1, q[0]).when(b == 2, q[1]).otherwise(q[2])
        hi = F.when(b == 0, q[0]).when(b == 1, q[1]).when(b == 2, q[2]).otherwise(F.col(f"hi_{c}"))
        new_cols[c] = F.when(F.col("s") == 0, F.col(c)).otherwise(lo + F.col(f"_v{i}") * (hi - lo))
    pert = pert.withColumns(new_cols)
    pert = pert.withColumns({f"_z{i}": (F.col(f"_pb{i}") == F.col(f"_ib{i}")).cast("double") for i in range(p)})
    d2 = sum((1.0 - F.col(f"_z{i}")) ** 2 for i in range(p))
    width = 0.75 * (p ** 0.5)
    pert = pert.withColumn("_w", F.sqrt(F.exp(-d2 / (width * width))))
    scored = model.transform(pert).select("inst", "prediction", "_w", *[f"_z{i}" for i in range(p)])

    # One group per explained instance holds exactly n_samples rows (a
    # parameter, independent of the data size): weighted ridge with numpy.
    def fit(pdf):
        import numpy as np
        import pandas as pd
        Z = pdf[[f"_z{i}" for i in range(p)]].to_numpy()
        X = np.hstack([np.ones((len(Z), 1)), Z])
        wv = pdf["_w"].to_numpy()
        y = pdf["prediction"].to_numpy()
        A = X.T @ (X * wv[:, None])
        pen = np.full(p + 1, alpha)
        pen[0] = 0.0
        coef = np.linalg.lstsq(A + np.diag(pen), X.T @ (wv * y), rcond=None)[0]
        return pd.DataFrame({"inst": pdf["inst"].iloc[0], "feature": list(features), "weight": coef[1:]})

    long = scored.groupBy("inst").applyInPandas(fit, "inst string, feature string, weight double")
    w = Window.partitionBy("inst").orderBy(F.desc(F.abs("weight")), "feature")
    return long.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top) \
               .select(F.col("inst").alias("instance"), "feature", "weight", "rank")
