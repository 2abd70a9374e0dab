"""X4 draws: replicates do not overlap, indices are uniform, and the oversamplers return what was asked for."""
import numpy as np
from pyspark.sql import functions as F

from ripplet.functions.random import dense_index, index_sql, uniform_sql
from ripplet.operators import knn


def test_replicates_share_no_more_draws_than_chance(spark):
    n = 100_000
    d = spark.range(n).select("id", *[F.expr(index_sql("42", str(b), "id", str(n))).alias(f"b{b}") for b in (5, 6)]).toPandas()
    for shift in (0, 7919, 1, 1000003 % n):
        same = (d.b6.to_numpy() == np.roll(d.b5.to_numpy(), -shift)).mean()
        assert same < 20 / n
    assert abs(d.b5.mean() / n - 0.5) < 0.01 and d.b5.nunique() > 0.62 * n


def test_uniforms(spark):
    u = spark.range(20_000).select(F.expr(uniform_sql("1", "id", "3")).alias("u")).toPandas().u
    assert 0 <= u.min() and u.max() < 1 and abs(u.mean() - 0.5) < 0.01 and abs(u.var() - 1 / 12) < 0.005


def test_dense_index(spark):
    df = spark.range(500).select((F.col("id") * 7 + 3).alias("k"))
    got = sorted(r["_i"] for r in dense_index(df, "k", 500).collect())
    assert got == list(range(500))


def vectors(spark, n_minority, n_majority):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=3).tolist(), int(i < n_minority)) for i in range(n_minority + n_majority)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, y int")


def test_few_minority_points_still_give_every_row(spark):
    for few in (2, 4, 6):
        out = knn.smote(vectors(spark, few, 36), k=5).collect()
        assert len(out) == 36 - few and all(r.seed_id != r.neighbour_id and r.neighbour_id < few for r in out)
        ada = knn.adasyn(vectors(spark, few, 36), k=5)
        assert ada.where("status = 'generated'").count() >= 36 - few - few
    assert knn.smote(vectors(spark, 1, 5)).count() == 0
    assert knn.adasyn(vectors(spark, 1, 5)).collect()[0].status == "not applicable"


def test_ties_go_to_the_smaller_id(spark):
    rng = np.random.default_rng(3)
    pts = [(i, [float(x) for x in rng.integers(0, 3, 2)]) for i in range(300)]
    df = spark.createDataFrame(pts, "id long, vec array<double>")
    got = {}
    for r in knn.knn_join(df.withColumnRenamed("id", "qid"), df.withColumnRenamed("id", "rid"), 5, exclude_self=True, block_rows=64).collect():
        got.setdefault(r.qid, []).append((r["rank"], r.rid))
    v = np.array([p for _, p in pts])
    for q, found in got.items():
        d = np.sqrt(((v - v[q]) ** 2).sum(axis=1))
        order = [int(i) for i in np.lexsort((np.arange(len(v)), d)) if i != q][:5]
        assert [i for _, i in sorted(found)] == order
