"""Ranks of whole groups by value buckets and prefix sums equal those of one sort."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from ripplet.functions import ranks
from ripplet.operators.metrics import roc_auc


@pytest.mark.parametrize("buckets", [2, 64])
def test_pooled_ranks_and_auc(spark, buckets):
    rng = np.random.default_rng(1)
    rows = [("a", float(np.round(x, 1)), int(y)) for x, y in zip(rng.normal(size=800), rng.random(800) < 0.4)]
    rows += [("hot", 1.0, i % 2) for i in range(300)] + [("one", float(i), 1) for i in range(5)] + [("a", None, 1), ("a", 0.5, None)]
    df = spark.createDataFrame(rows, "g string, score double, label int")
    got = {r.g: (r.auc, r.n_pos, r.n_neg) for r in ranks.pooled_roc_auc(df, ("g",), buckets=buckets).collect()}
    want = {r.g: (r.auc, r.n_pos, r.n_neg) for r in roc_auc(df, ("g",)).collect()}
    assert got == want and got["hot"][0] == 0.5 and got["one"][0] is None
    whole = ranks.pooled_roc_auc(df, buckets=buckets).first()
    assert abs(whole.auc - roc_auc(df.withColumn("k", F.lit(0)), ("k",)).first().auc) < 1e-12
    known = df.where("score IS NOT NULL")
    pooled = ranks.pooled_midranks(known, "score", buckets=buckets)
    s = np.array([r[1] for r in rows if r[1] is not None])
    for r in pooled.collect():
        assert r.midrank == (s < r.score).sum() + ((s == r.score).sum() + 1) / 2 and r.n == (s == r.score).sum()
    ex = pooled._jdf.queryExecution().executedPlan().toString()
    assert "_bucket" in ex
    assert ranks.pooled_roc_auc(df.limit(0), ("g",), buckets=buckets).count() == 0
