"""Search and explanation helpers."""
import math

from pyspark.sql import functions as F

from ripplet.operators.explain import combined_importance
from ripplet.operators.models import early_stop_rounds
from ripplet.operators.search import (best_so_far, genes_to_params, genes_to_params_df, genetic_search,
                                      grid_candidates, params_to_genes, search_log, tpe_candidates, tpe_search)

SPACE = {"lr": ("log", 1e-3, 1e-1), "depth": ("int", 2, 8), "sub": ("uniform", 0.5, 1.0)}


def test_gene_mapping_roundtrip_and_columns(spark):
    p = genes_to_params([0.0, 1.0, 0.5], SPACE)
    assert math.isclose(p["lr"], 1e-3) and p["depth"] == 8 and math.isclose(p["sub"], 0.75)
    g = params_to_genes({"lr": 1e-2, "depth": 5, "sub": 0.6}, SPACE)
    assert math.isclose(genes_to_params(g, SPACE)["lr"], 1e-2)
    df = spark.createDataFrame([(0.0, 1.0, 0.5)], "g0 double, g1 double, g2 double")
    r = genes_to_params_df(df, SPACE).first()
    assert math.isclose(r.lr, 1e-3) and r.depth == 8 and math.isclose(r.sub, 0.75)


def test_early_stop_rule():
    curve = [5, 4, 3, 3.5, 3.2, 3.1, 3.05, 3.3]
    assert early_stop_rounds(curve, patience=3) == 3          # best at index 2, stop after 3 misses
    assert early_stop_rounds([3, 2, 1], patience=30) == 3


def test_grid_tpe_and_genetic_drivers():
    assert len(grid_candidates({"a": [1, 2], "b": [3, 4, 5]})) == 6
    f = lambda p: (math.log10(p["lr"]) + 2) ** 2 + (p["depth"] - 5) ** 2 / 10 + (p["sub"] - 0.8) ** 2
    hist = [(p, f(p)) for p in [genes_to_params([x, x, x], SPACE) for x in (0.1, 0.3, 0.5, 0.7, 0.9)]]
    props = tpe_candidates(hist, SPACE, 3, seed=1)
    assert len(props) == 3 and all(SPACE["lr"][1] <= p["lr"] <= SPACE["lr"][2] for p in props)
    batches = []

    def many(ps):
        batches.append(len(ps))
        return [f(p) for p in ps]
    log = genetic_search(many, SPACE, pop=6, gens=4, seed=3, mut_p=0.1, cx_p=0.2)
    assert len(batches) <= 5 and sum(batches) == len(log) < 6 * 5   # one batch a generation, known genes are not scored again
    trials = tpe_search(many, SPACE, n_trials=20, batch=5, startup=10, seed=2)
    assert len(trials) == 20 and batches[-3:] == [10, 5, 5] and trials == tpe_search(many, SPACE, 20, 5, 10, 2)
    assert min(s for _, s in trials[10:]) <= min(s for _, s in trials[:10])
    keys = [tuple(sorted(p.items())) for p, _ in log]
    assert len(keys) == len(set(keys))                         # memoised: no re-evaluation


def test_best_so_far_and_combined_importance(spark):
    log = search_log(spark, "grid", [({"x": v}, v) for v in (3.0, 1.0, 2.0)])
    assert [r.best_so_far for r in best_so_far(log).orderBy("eval_no").collect()] == [3.0, 1.0, 1.0]
    sc = spark.createDataFrame([("gain", "a", 3.0), ("gain", "b", 1.0), ("perm", "a", -1.0), ("perm", "b", 2.0)],
                               "method string, feature string, score double")
    r = {x.feature: x for x in combined_importance(sc).collect()}
    assert math.isclose(r["a"].combined, 0.375) and math.isclose(r["b"].combined, 0.625)
    assert r["b"].rank == 1


def test_batch_cv_equals_one_model_at_a_time_and_refit_stops_on_val(spark, monkeypatch):
    import numpy as np
    from ripplet.operators import boosting as B
    from ripplet.operators import search as H
    rng = np.random.default_rng(5)
    rows = [(s, d, "train" if d < 120 else "val" if d < 160 else "test", float(x), float(z), float(x * x + 0.1 * e))
            for s in "ab" for d, (x, z, e) in enumerate(rng.normal(size=(200, 3)))]
    panel = spark.createDataFrame(rows, "symbol string, date int, split string, f0 double, f1 double, target_vol double")
    train = panel.where("split = 'train'")
    table = H.cv_table(train, ["f0", "f1"])
    cands = [{"rate": 0.3, "depth": 2}, {"rate": 0.1, "depth": 4, "rows": 0.7}]
    got = H.cv_scores(table, cands, rounds=6)
    for c, score in zip(cands, got):
        rmse = []
        for k in range(3):
            spec = B.Spec(fold=k, rounds=6, patience=None, **{**H.PLAIN, **c})
            model = B.fit_boosted_many(table, [spec])[0]
            test = H.time_series_folds(train, n_splits=3).where(f"fold = {k} AND role = 'test'")
            rmse.append(model.predict(test).agg(F.sqrt(F.avg((F.col("prediction") - F.col("target_vol")) ** 2))).first()[0])
        assert abs(score - sum(rmse) / 3) < 1e-9
    models, metrics = H.refit_best(panel, ["f0", "f1"], {"grid": cands[0], "tpe": cands[1]}, rounds=40, patience=3)
    out = {(r.symbol, r.model, r.split): r for r in metrics.collect()}
    assert len(out) == 8 and all(out["a", n, "val"].rounds == len(m.trees) <= 40 for n, m in models.items())
    assert out["a", "grid", "val"].r2 > 0.5
