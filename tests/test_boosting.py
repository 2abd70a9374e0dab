"""Boosted trees against a plain numpy version; continuation, joint runs, patience; Tree SHAP against subset sums."""
import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ripplet.operators import boosting as B
from ripplet.operators import explain, shap

FEATS = ["f0", "f1", "f2"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(7)
    n = 600
    x = rng.normal(size=(n, 3)) * [1.0, 5.0, 0.1] + [0, 2, 1]
    vol = 0.3 + 0.2 * x[:, 0] ** 2 + 0.05 * x[:, 1] * (x[:, 2] > 1) + 0.1 * rng.normal(size=n)
    regime = (vol > np.median(vol)).astype(int)
    split = np.where(np.arange(n) < 400, "train", np.where(np.arange(n) < 500, "val", "test"))
    data = [("s", i, str(split[i]), *(None if (i + 7 * j) % 50 == 0 else float(x[i, j]) for j in range(3)), float(vol[i]), int(regime[i])) for i in range(n)]
    return spark.createDataFrame(data, "symbol string, date int, split string, f0 double, f1 double, f2 double, target_vol double, target_regime int").cache()


@pytest.fixture(scope="module")
def table(rows):
    on = [(F.col("split") == "train", F.col("split") == "val"), ((F.col("split") == "train") & (F.col("target_regime") == 1), F.col("split") == "val")]
    return B.bin_table(rows, FEATS, ["target_vol", "target_regime"], on, ["symbol", "date"], max_bins=16, part_rows=150)


def plain_fit(model, rows, spec, label):
    """The same boosting without Spark, sampling or pruning of the search: every cut of every node is tried."""
    pdf = rows.where("split = 'train'").toPandas()
    bins, y = model.bins_of(model.matrix([pdf[f] for f in FEATS])), pdf[label].to_numpy(float)
    base = y.mean() if spec.task == "regression" else math.log(y.mean() / (1 - y.mean()))
    margin, lam = np.full(len(y), base), spec.reg_lambda

    def grow(idx, g, h, depth):
        gs, hs = g[idx].sum(), h[idx].sum()
        best = (1e-12, None)
        for f in range(len(FEATS)):
            for cut in range(16):
                left = idx[bins[idx, f] <= cut]
                right = idx[bins[idx, f] > cut]
                hl, hr = h[left].sum(), h[right].sum()
                if depth < spec.depth and len(left) and len(right) and hl >= spec.min_child and hr >= spec.min_child:
                    gain = 0.5 * (g[left].sum() ** 2 / (hl + lam) + g[right].sum() ** 2 / (hr + lam) - gs ** 2 / (hs + lam))
                    if gain > best[0] + 1e-9:
                        best = (gain, (left, right))
        if best[1] is None:
            margin[idx] += -spec.rate * gs / (hs + lam)
        else:
            for part in best[1]:
                grow(part, g, h, depth + 1)

    for _ in range(spec.rounds):
        if spec.task == "regression":
            g, h = margin - y, np.ones(len(y))
        else:
            p = 1 / (1 + np.exp(-margin))
            g, h = p - y, p * (1 - p)
        grow(np.arange(len(y)), g, h, 0)
    return margin


@pytest.mark.parametrize("task,label,column", [("regression", 0, "target_vol"), ("classification", 1, "target_regime")])
def test_equals_a_plain_version(table, rows, task, label, column):
    spec = B.Spec(task, label, 0, rounds=4, patience=None, rate=0.3, depth=3, rows=1, columns=1)
    model = B.fit_boosted_many(table, [spec], keep_rounds=3)[0]
    pdf = rows.where("split = 'train'").toPandas()
    got = model.margin(model.matrix([pdf[f] for f in FEATS]))
    np.testing.assert_allclose(got, plain_fit(model, rows, spec, column), atol=1e-9)


def same(a, b):
    assert len(a.trees) == len(b.trees)
    for s, t in zip(a.trees, b.trees):
        np.testing.assert_array_equal(s.feature, t.feature)
        np.testing.assert_array_equal(s.bin, t.bin)
        np.testing.assert_allclose(s.value, t.value, atol=1e-9)
    np.testing.assert_allclose(a.curve, b.curve, atol=1e-9)


def test_tasks_that_share_out_models_grow_the_same_trees(table, rows):
    assert table.parts == 4
    on = [(F.col("split") == "train", F.col("split") == "val"), ((F.col("split") == "train") & (F.col("target_regime") == 1), F.col("split") == "val")]
    whole = B.bin_table(rows, FEATS, ["target_vol", "target_regime"], on, ["symbol", "date"], max_bins=16)
    assert whole.parts == 1
    specs = [B.Spec(rounds=10, patience=2, rate=0.4, depth=6, min_child=1.0), B.Spec("classification", 1, rounds=5, patience=None), B.Spec(fold=1, rounds=4)]
    for a, b in zip(B.fit_boosted_many(table, specs), B.fit_boosted_many(whole, specs)):
        same(a, b)


def test_joint_runs_written_margins_and_shuffled_sums_change_nothing(table, monkeypatch):
    specs = [B.Spec(rounds=12, patience=None, rate=0.2), B.Spec("classification", 1, rounds=9, patience=None, depth=2, seed=5),
             B.Spec(fold=1, rounds=7, patience=None, depth=3)]
    alone = [B.fit_boosted_many(table, [s], keep_rounds=1000)[0] for s in specs]
    for a, b in zip(alone, B.fit_boosted_many(table, specs, keep_rounds=4)):
        same(a, b)
    monkeypatch.setattr(B, "GATHER_BYTES", 0)
    same(alone[0], B.fit_boosted_many(table, specs[:1], keep_rounds=5)[0])


def test_patience_ends_the_loop_at_the_best_round(table, rows):
    spec = B.Spec(rounds=400, patience=4, rate=0.5)
    model = B.fit_boosted_many(table, [spec])[0]
    best = int(np.argmin(model.curve)) + 1
    assert len(model.trees) == best == B.early_stop_rounds(model.curve, 4) and len(model.curve) == best + 4
    mse = model.predict(rows.where("split = 'val'")).agg(F.avg((F.col("prediction") - F.col("target_vol")) ** 2)).first()[0]
    assert abs(mse - model.curve[best - 1]) < 1e-9
    never = B.fit_boosted_many(table, [B.Spec(rounds=6, patience=4, rate=0.01)])[0]
    assert len(never.trees) == 6 == len(never.curve)


def test_degenerate_rows(spark, rows):
    flat = rows.withColumn("f0", F.lit(1.0)).withColumn("f1", F.lit(None).cast("double")).withColumn("target_vol", F.lit(2.0))
    model = B.fit_boosted(flat, FEATS, "regression", "target_vol", F.col("split") == "train", F.lit(False), rounds=2)
    assert {r.prediction for r in model.predict(flat).select("prediction").distinct().collect()} == {2.0}
    none = B.fit_boosted(rows.limit(0), FEATS, "regression", "target_vol", F.lit(True), F.lit(False), rounds=2)
    assert none.predict(rows.limit(0)).count() == 0


def conditional(tree, thr, x, known, node=0):
    """Expected leaf value when only the features of ``known`` are fixed (cover-weighted elsewhere)."""
    f = int(tree.feature[node])
    if f < 0:
        return tree.value[node]
    left, right = 2 * node + 1, 2 * node + 2
    if f in known:
        return conditional(tree, thr, x, known, left if x[f] <= thr[node] else right)
    return sum(tree.cover[c] / tree.cover[node] * conditional(tree, thr, x, known, c) for c in (left, right))


def test_tree_shap_equals_the_subset_sum_and_adds_up(table, rows):
    model = B.fit_boosted_many(table, [B.Spec(rounds=8, patience=None, depth=5, rate=0.4)])[0]
    got = shap.tree_shap(model, rows.where("split = 'test'"), ["symbol", "date"]).orderBy("date").collect()
    assert len(got) == 100 and all(abs(r.base + sum(r.phi) - r.margin) < 1e-9 for r in got)
    pdf = rows.where("split = 'test'").orderBy("date").toPandas()
    x, p = model.matrix([pdf[f] for f in FEATS]), len(FEATS)
    for i in (0, 17, 62, 99):
        for f in range(p):
            rest, phi = [j for j in range(p) if j != f], 0.0
            for k in range(p):
                for s in itertools.combinations(rest, k):
                    w = math.factorial(k) * math.factorial(p - k - 1) / math.factorial(p)
                    phi += w * sum(conditional(t, model.thresholds(t), x[i], {*s, f}) - conditional(t, model.thresholds(t), x[i], set(s)) for t in model.trees)
            assert abs(phi - got[i].phi[f]) < 1e-9


def test_importances_follow_the_node_table(spark, table):
    model = B.fit_boosted_many(table, [B.Spec(rounds=5, patience=None)])[0]
    got = {r.feature: (r.gain, r.weight, r.cover) for r in explain.native_importance(model, spark).collect()}
    want = {}
    for t in model.trees:
        for n in np.flatnonzero(t.feature >= 0):
            want.setdefault(FEATS[t.feature[n]], []).append((t.gain[n], t.cover[n]))
    assert set(got) == set(want)
    for f, v in want.items():
        np.testing.assert_allclose(got[f], (np.mean([g for g, _ in v]), len(v), np.mean([c for _, c in v])))
