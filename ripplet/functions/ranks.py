"""Sums below a value over groups of any size (K5, I3): no group is ever one task.

A window over a whole group sorts it in one task.  Here equal values are first counted (a hot value is one row), the
value axis is cut at quantiles into buckets, bucket totals are summed up in order, and windows run inside (group, bucket).
The cut points and totals are bounded by groups x buckets, not by rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ripplet.session import materialize

BUCKETS = 64


def sums_below(counts: DataFrame, keys: Sequence[str], order: str, values: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """``counts``: one row per (keys, ``order``).  Adds ``<value>_below`` for each of ``values``: its sum over smaller
    ``order`` in the group.  Null orders come first."""
    keys = list(keys)
    counts = materialize(counts, "rank-counts")
    cuts = counts.agg(F.percentile_approx(order, [i / buckets for i in range(1, buckets)], 10_000).alias("c")).first()["c"] or []
    cuts = sorted(set(cuts))
    bucket = F.coalesce(F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c < F.col(order))), F.lit(0)) if cuts else F.lit(0)
    counts = counts.withColumn("_bucket", F.when(F.col(order).isNull(), F.lit(-1)).otherwise(bucket))
    totals = counts.groupBy(*keys, "_bucket").agg(*[F.sum(v).alias(f"_t_{v}") for v in values])
    ahead = Window.partitionBy(*keys, F.lit(0)).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*keys, "_bucket", *[F.coalesce(F.sum(f"_t_{v}").over(ahead), F.lit(0)).alias(f"_a_{v}") for v in values])
    inside = Window.partitionBy(*keys, "_bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    out = counts.withColumns({f"{v}_below": F.coalesce(F.sum(v).over(inside), F.lit(0)) for v in values})
    match = F.lit(True)
    right = totals.select(*[F.col(c).alias(f"_r_{c}") for c in (*keys, "_bucket")], *[f"_a_{v}" for v in values])
    for c in (*keys, "_bucket"):
        match = match & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    out = out.join(right, match)
    return out.select(*[c for c in counts.columns if c != "_bucket"], *[(F.col(f"{v}_below") + F.col(f"_a_{v}")).alias(f"{v}_below") for v in values])


def pooled_midranks(df: DataFrame, score: str, keys: Sequence[str] = (), out: str = "midrank", buckets: int = BUCKETS) -> DataFrame:
    """K5 for groups of any size: (keys, score, n, ``out``) of every distinct score; the rank is 1-based and averaged over ties."""
    counts = df.groupBy(*keys, score).agg(F.count(F.lit(1)).alias("n"))
    below = sums_below(counts, keys, score, ["n"], buckets)
    return below.select(*keys, score, "n", (F.col("n_below") + (F.col("n") + 1) / 2.0).alias(out))


def pooled_roc_auc(df: DataFrame, keys: Sequence[str] = (), label: str = "label", score: str = "score", buckets: int = BUCKETS) -> DataFrame:
    """I3 for groups of any size: exact ROC AUC with ties as 1/2; NULL when one class is absent."""
    from ripplet.operators.metrics import score_counts
    c = sums_below(score_counts(df, tuple(keys), label, score), keys, score, ["neg"], buckets)
    agg = c.groupBy(*keys).agg(F.sum(F.col("pos") * (F.col("neg_below") + 0.5 * F.col("neg"))).alias("_u"),
                               F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
    return agg.select(*keys, F.try_divide(F.col("_u"), (F.col("n_pos") * F.col("n_neg")).cast("double")).alias("auc"), "n_pos", "n_neg")
