"""Hyper-parameter search over expanding-window folds (H1-H8).

H1  cv_scores: every (candidate, fold) of a batch is a model of one boosting run
    over one binned table (``ripplet.operators.boosting``), so a batch costs as
    many Spark jobs as its deepest candidate alone.  Folds are the D6 expanding
    windows per symbol; medians and histogram cuts are fitted on the fold's train
    rows.  RMSE on the fold's test rows, mean over folds.  cv_score does the same
    for any Spark ML estimator, one fit a fold, folds in flight together.
H2  grid, H3 random: one batch.  H4 TPE-style density-ratio sampler: batches of
    proposals.  H5 genetic search: one batch a generation, genes rounded to four
    decimals are evaluated once.
H6  gene -> parameter mapping (log / linear / integer scaling).
H7  best-so-far curve as a running-minimum window over the evaluation log.
H8  refit_best: the best candidates of all methods in one run on the train split,
    stopped on val, scored on val and test.
Candidates are a handful of parameter dicts (not data); the evaluation log is a
DataFrame.
"""

from __future__ import annotations

import itertools
import json
import math
import random
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ripplet.operators import boosting
from ripplet.operators.metrics import regression_metrics
from ripplet.operators.models import fit_pipeline
from ripplet.operators.splits import time_series_folds

#: Search space of the boosted trees (names of ``boosting.Spec``) and the grid's values.
BOOSTED_SPACE = {"rate": ("log", 1e-2, 3e-1), "depth": ("int", 3, 10), "min_child": ("int", 1, 10),
                 "rows": ("uniform", 0.6, 1.0), "columns": ("uniform", 0.6, 1.0), "reg_lambda": ("log", 1e-3, 10.0)}
BOOSTED_GRID = {"rate": [0.03, 0.1], "depth": [4, 6, 8], "rows": [0.7, 0.9], "columns": [0.7, 0.9]}
#: What a candidate does not name.
PLAIN = {"rate": 0.3, "depth": 6, "min_child": 1.0, "reg_lambda": 1.0, "rows": 1.0, "columns": 1.0}


def cv_table(train: DataFrame, features: list[str], label: str = "target_vol", n_splits: int = 3) -> boosting.BinTable:
    """The binned train rows with a role in every expanding-window fold (H1)."""
    keys = ["symbol", "date"]
    folds = time_series_folds(train.select(*keys, label, *features), n_splits=n_splits)
    wide = folds.groupBy(*keys).agg(*[F.first(c).alias(c) for c in (label, *features)],
                                    *[F.max(F.when(F.col("fold") == k, F.col("role"))).alias(f"_role{k}") for k in range(n_splits)])
    on = [(F.col(f"_role{k}") == "train", F.col(f"_role{k}") == "test") for k in range(n_splits)]
    return boosting.bin_table(wide, features, [label], on, keys)


def cv_scores(table: boosting.BinTable, candidates: list[dict], rounds: int = 200, seed: int = 42) -> list[float]:
    """H1 of a whole batch: mean over folds of the RMSE on the fold's test rows, for each candidate."""
    k = len(table.cuts)
    specs = [boosting.Spec(fold=f, rounds=rounds, patience=None, seed=seed, **{**PLAIN, **c}) for c in candidates for f in range(k)]
    models = boosting.fit_boosted_many(table, specs)
    rmse = [math.sqrt(m.curve[-1]) for m in models]
    return [sum(rmse[i * k:(i + 1) * k]) / k for i in range(len(candidates))]


def refit_best(panel: DataFrame, features: list[str], best: dict[str, dict], label: str = "target_vol", rounds: int = 1000,
               patience: int = 30, seed: int = 42) -> tuple[dict[str, boosting.BoostedModel], DataFrame]:
    """H8: the best parameters of every method, fitted together on train and stopped on val; (models, metrics per
    symbol, method and split; predictions clipped at 0)."""
    table = boosting.bin_table(panel, features, [label], [(F.col("split") == "train", F.col("split") == "val")], ["symbol", "date"])
    specs = [boosting.Spec(rounds=rounds, patience=patience, seed=seed, **{**PLAIN, **p}) for p in best.values()]
    models = dict(zip(best, boosting.fit_boosted_many(table, specs)))
    scored = panel.where(F.col("split").isin("val", "test"))
    for name, m in models.items():
        scored = m.predict(scored, f"_p_{name}")
    long = scored.select("symbol", "split", F.col(label).alias("y_true"), F.inline(F.array(*[
        F.struct(F.lit(n).alias("model"), F.greatest(F.col(f"_p_{n}"), F.lit(0.0)).alias("y_pred"), F.lit(len(m.trees)).alias("rounds"))
        for n, m in models.items()])))
    return models, regression_metrics(long, ("symbol", "model", "split", "rounds"))


def cv_score(train: DataFrame, make_estimator, params: dict, label: str = "target_vol",
             n_splits: int = 3) -> float:
    """H1 for a Spark ML estimator."""
    folds = time_series_folds(train, n_splits=n_splits).cache()

    def one(f: int) -> float:
        tr = folds.where((F.col("fold") == f) & (F.col("role") == "train"))
        te = folds.where((F.col("fold") == f) & (F.col("role") == "test"))
        model = fit_pipeline(make_estimator(params), tr)
        e = F.greatest(F.col("prediction"), F.lit(0.0)) - F.col(label)
        return model.transform(te).agg(F.sqrt(F.avg(e * e)).alias("r")).first()["r"]

    with ThreadPoolExecutor(max_workers=n_splits) as ex:
        scores = list(ex.map(one, range(n_splits)))
    folds.unpersist()
    return float(sum(scores) / len(scores))


def grid_candidates(space: dict[str, list]) -> list[dict]:
    """H2: full Cartesian product of the listed values."""
    keys = list(space)
    return [dict(zip(keys, vals)) for vals in itertools.product(*[space[k] for k in keys])]


def random_candidates(space: dict[str, tuple], n: int, seed: int = 42) -> list[dict]:
    """H3: ("log", lo, hi) | ("int", lo, hi) | ("uniform", lo, hi) draws."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        c = {}
        for k, (kind, lo, hi) in space.items():
            if kind == "log":
                c[k] = math.exp(rng.uniform(math.log(lo), math.log(hi)))
            elif kind == "int":
                c[k] = rng.randint(lo, hi)
            else:
                c[k] = rng.uniform(lo, hi)
        out.append(c)
    return out


def genes_to_params(genes: list[float], space: dict[str, tuple]) -> dict:
    """H6: genes in [0, 1] -> parameters (log / int / linear scaling)."""
    p = {}
    for g, (k, (kind, lo, hi)) in zip(genes, space.items()):
        g = min(max(g, 0.0), 1.0)
        if kind == "log":
            p[k] = math.exp(math.log(lo) + g * (math.log(hi) - math.log(lo)))
        elif kind == "int":
            p[k] = int(round(lo + g * (hi - lo)))
        else:
            p[k] = lo + g * (hi - lo)
    return p


def genes_to_params_df(cands: DataFrame, space: dict[str, tuple]) -> DataFrame:
    """H6 as column expressions over a candidate table with columns g0..gk."""
    cols = []
    for i, (k, (kind, lo, hi)) in enumerate(space.items()):
        g = F.least(F.greatest(F.col(f"g{i}"), F.lit(0.0)), F.lit(1.0))
        if kind == "log":
            cols.append(F.exp(F.lit(math.log(lo)) + g * F.lit(math.log(hi) - math.log(lo))).alias(k))
        elif kind == "int":
            cols.append(F.round(F.lit(float(lo)) + g * F.lit(float(hi - lo))).cast("int").alias(k))
        else:
            cols.append((F.lit(float(lo)) + g * F.lit(float(hi - lo))).alias(k))
    return cands.select("*", *cols)


def tpe_candidates(history: list[tuple[dict, float]], space: dict[str, tuple], n: int, seed: int,
                   gamma: float = 0.25, n_draws: int = 24) -> list[dict]:
    """H4: Bergstra et al. (2011) style proposal: split history into good /
    bad by the gamma-quantile of the score, draw candidates around good points
    in gene space and keep those with the best good/bad Parzen density ratio."""
    rng = random.Random(seed)
    keys = list(space)
    if len(history) < 4:
        return random_candidates(space, n, seed)
    inv = [(params_to_genes(p, space), s) for p, s in history]
    inv.sort(key=lambda t: t[1])
    k = max(1, int(math.ceil(gamma * len(inv))))
    good, bad = [g for g, _ in inv[:k]], [g for g, _ in inv[k:]]
    bw = 0.15

    def dens(x, pts):
        return sum(math.exp(-sum((a - b) ** 2 for a, b in zip(x, p)) / (2 * bw * bw)) for p in pts) / len(pts) + 1e-12

    props = []
    for _ in range(n_draws * n):
        base = rng.choice(good)
        x = [min(max(b + rng.gauss(0, bw), 0.0), 1.0) for b in base]
        props.append((dens(x, good) / dens(x, bad), x))
    props.sort(key=lambda t: -t[0])
    return [genes_to_params(x, space) for _, x in props[:n]]


def params_to_genes(p: dict, space: dict[str, tuple]) -> list[float]:
    out = []
    for k, (kind, lo, hi) in space.items():
        v = p[k]
        if kind == "log":
            out.append((math.log(v) - math.log(lo)) / (math.log(hi) - math.log(lo)))
        else:
            out.append((v - lo) / (hi - lo))
    return out


def tpe_search(evaluate, space: dict[str, tuple], n_trials: int = 20, batch: int = 5, startup: int = 10,
               seed: int = 42) -> list[tuple[dict, float]]:
    """H4: ``startup`` random trials, then batches of proposals from the density ratio of all trials so far.
    ``evaluate`` scores a list of candidates at once; the trials come back in order and follow from the seed."""
    trials: list[tuple[dict, float]] = []
    while len(trials) < n_trials:
        n = min(startup if not trials else batch, n_trials - len(trials))
        wanted = random_candidates(space, n, seed) if not trials else tpe_candidates(trials, space, n, seed + len(trials))
        trials += list(zip(wanted, evaluate(wanted)))
    return trials


def genetic_search(evaluate, space: dict[str, tuple], pop: int = 8, gens: int = 2, seed: int = 42,
                   tour: int = 3, cx_p: float = 0.7, cx_alpha: float = 0.5, mut_p: float = 0.3,
                   mut_sigma: float = 0.15, mut_indpb: float = 0.4) -> list[tuple[dict, float]]:
    """H5: tournament selection, blend crossover, Gaussian mutation, clipping to [0, 1].  ``evaluate`` scores the new
    candidates of a generation at once; genes (rounded to 4 decimals) whose
    parameters were scored before are not scored again."""
    rng = random.Random(seed)
    memo: dict[tuple, float] = {}
    log: list[tuple[dict, float]] = []

    def scores(people: list[list[float]]) -> list[float]:
        params = [genes_to_params([round(x, 4) for x in g], space) for g in people]
        keys = [tuple(p.values()) for p in params]
        new = {k: p for k, p in zip(keys, params) if k not in memo}
        if new:
            memo.update(zip(new, evaluate(list(new.values()))))
            log.extend((p, memo[k]) for k, p in new.items())
        return [memo[k] for k in keys]

    popu = [[rng.random() for _ in space] for _ in range(pop)]
    fit = scores(popu)
    for _ in range(gens):
        sel = []
        for _ in range(pop):
            cand = rng.sample(range(pop), tour)
            sel.append(list(popu[min(cand, key=lambda i: fit[i])]))
        for i in range(0, pop - 1, 2):
            if rng.random() < cx_p:
                a, b = sel[i], sel[i + 1]
                for j in range(len(a)):
                    gamma = (1 + 2 * cx_alpha) * rng.random() - cx_alpha
                    a[j], b[j] = (1 - gamma) * a[j] + gamma * b[j], gamma * a[j] + (1 - gamma) * b[j]
        for g in sel:
            if rng.random() < mut_p:
                for j in range(len(g)):
                    if rng.random() < mut_indpb:
                        g[j] += rng.gauss(0, mut_sigma)
        popu = [[min(max(x, 0.0), 1.0) for x in g] for g in sel]
        fit = scores(popu)
    return log


def search_log(spark: SparkSession, method: str, trials: list[tuple[dict, float]]) -> DataFrame:
    """Evaluation log as a DataFrame: (method, eval_no, params json, rmse)."""
    rows = [(method, i + 1, json.dumps(p, sort_keys=True), float(s)) for i, (p, s) in enumerate(trials)]
    return spark.createDataFrame(rows, "method string, eval_no int, params string, rmse double")


def best_so_far(log: DataFrame) -> DataFrame:
    """H7: running minimum of the score per method."""
    w = Window.partitionBy("method").orderBy("eval_no").rowsBetween(Window.unboundedPreceding, 0)
    return log.withColumn("best_so_far", F.min("rmse").over(w))
