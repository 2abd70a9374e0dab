"""SMOTE / ADASYN / undersampling properties on the embeddings table."""
import numpy as np
from pyspark.sql import functions as F

from ripplet.operators import knn as KNN
from ripplet.operators.naive_bayes import embeddings_split
from ripplet.sources.tables import read_table

SF = "/root/testdata/sf0.001"


def _train(spark):
    e = embeddings_split(read_table(spark, SF, "embeddings")).where(F.col("split") == "train")
    return e.withColumn("y", (F.col("label") == 0).cast("int"))


def test_smote_counts_and_segments(spark):
    tr = _train(spark)
    n1 = tr.where("y = 1").count()
    n0 = tr.where("y = 0").count()
    syn = KNN.smote(tr, k=5)
    rows = syn.collect()
    assert len(rows) == abs(n0 - n1)
    vecs = {r.vec_id: np.asarray(r.embedding, float) for r in tr.select("vec_id", "embedding").collect()}
    nn = {(r.qid, r.rid) for r in KNN.knn_join(
        tr.where("y = 1").select(F.col("vec_id").alias("qid"), F.col("embedding").alias("vec")),
        tr.where("y = 1").select(F.col("vec_id").alias("rid"), F.col("embedding").alias("vec")), 5,
        exclude_self=True).collect()}
    for r in rows[:50]:
        assert 0.0 <= r.u < 1.0
        assert (r.seed_id, r.neighbour_id) in nn
        expect = vecs[r.seed_id] + r.u * (vecs[r.neighbour_id] - vecs[r.seed_id])
        np.testing.assert_allclose(np.asarray(r.embedding, float), expect, rtol=1e-5, atol=1e-6)
    assert sorted(x.synthetic_id for x in KNN.smote(tr, k=5).collect()) == sorted(x.synthetic_id for x in rows)


def test_adasyn_generates_about_the_gap(spark):
    tr = _train(spark)
    n1 = tr.where("y = 1").count()
    n0 = tr.where("y = 0").count()
    out = KNN.adasyn(tr, k=5)
    if "status" in out.columns and out.where("status = 'not applicable'").count():
        return
    g = out.count()
    assert abs(g - abs(n0 - n1)) <= max(5, 0.1 * abs(n0 - n1))


def test_knn_matches_numpy(spark):
    e = embeddings_split(read_table(spark, SF, "embeddings"))
    q = e.where("split = 'test'").limit(20)
    r = e.where("split = 'train'")
    got = {}
    for row in KNN.knn_join(q.select(F.col("vec_id").alias("qid"), F.col("embedding").alias("vec")),
                            r.select(F.col("vec_id").alias("rid"), F.col("embedding").alias("vec")), 5).collect():
        got.setdefault(row.qid, []).append((row.rank, row.rid))
    R = [(x.vec_id, np.asarray(x.embedding, float)) for x in r.collect()]
    for x in q.collect():
        v = np.asarray(x.embedding, float)
        d = sorted((float(np.sqrt(((v - y) ** 2).sum())), i) for i, y in R)[:5]
        assert [rid for _, rid in sorted(got[x.vec_id])] == [i for _, i in d]


def test_resampling_happens_in_fit_only(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    from ripplet.operators import balance as G
    rng = np.random.default_rng(4)
    y = (rng.random(400) < 0.15).astype(int)
    rows = [(i, float(a + 1.5 * t), float(b - t), int(t)) for i, (a, b, t) in enumerate(zip(rng.normal(size=400), rng.normal(size=400), y))]
    df = spark.createDataFrame(rows, "id long, f0 double, f1 double, y int")
    vectors = VectorAssembler(inputCols=["f0", "f1"], outputCol="features")
    ready = vectors.transform(df)
    n1, n0 = int(y.sum()), int((1 - y).sum())
    count = lambda t: {r.y: (r["count"], r.w) for r in G.resample(ready, t, "y", "id").groupBy("y").agg(
        F.count("*").alias("count"), F.sum("weight").alias("w")).collect()}
    assert count("none") == {0: (n0, n0), 1: (n1, n1)} and count("smote")[1][0] == n0
    assert abs(count("adasyn")[1][0] - n0) <= 0.1 * n0
    assert count("class_weight")[0][0] == n0 and abs(count("class_weight")[0][1] - 200) < 1e-6 > abs(count("class_weight")[1][1] - 200)
    recall = {}
    for t in ("none", "smote", "adasyn", "class_weight"):
        est = LogisticRegression(featuresCol="features", labelCol="y", regParam=0.01)
        model = Pipeline(stages=[vectors, G.Resampled(est, t, "y", "id")]).fit(df)
        scored = model.transform(df)
        assert scored.count() == 400 and type(model.stages[-1]).__name__ == "LogisticRegressionModel"
        recall[t] = scored.where("y = 1 AND prediction = 1").count() / n1
    assert min(recall["smote"], recall["adasyn"], recall["class_weight"]) > recall["none"]


def test_pivot_join_is_exact_and_visits_few_cells(spark):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(12, 6)) * 20
    refs = np.concatenate([c + rng.normal(size=(60, 6)) for c in centres] + [np.repeat(centres[:1], 300, axis=0)])  # and a hot group of copies
    queries = np.concatenate([refs[::25], rng.normal(size=(20, 6)) * 20])
    frame = lambda x, name: spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], f"{name} long, vec array<double>")
    for k, block, same in ((5, 4096, False), (5, 40, True), (400, 100, False), (2000, 4096, False)):
        log = []
        got = KNN.knn_join(frame(queries, "qid"), frame(refs, "rid"), k, exclude_self=same, block_rows=block, log=log).collect()
        want = set()
        for q in range(len(queries)):
            d = np.sqrt(((refs - queries[q]) ** 2).sum(axis=1))
            order = [j for j in np.lexsort((np.arange(len(refs)), d)) if not (same and j == q)][:k]
            want |= {(q, int(j), r + 1) for r, j in enumerate(order)}
        assert {(r.qid, r.rid, r["rank"]) for r in got} == want
        if k == 5:
            size = log[2]
            pairs = sum(int(size[r.cell]) for visits in log[:2] for r in visits.collect())
            assert pairs < 0.5 * len(queries) * len(refs)
    assert KNN.knn_join(frame(queries, "qid"), frame(refs, "rid").limit(0), 3).count() == 0
