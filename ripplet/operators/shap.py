"""Tree SHAP (L3): exact path-dependent Shapley values of boosted trees (Lundberg et al., 2020), as a leaf-path table
applied to rows.

Each leaf of a tree is one row of the leaf-path table: its value, and for every distinct feature on its path the interval of
values that stay on the path and the share of training cover that does (the product over the feature's splits).  For one
row and leaf let o_f be 1 if the row's value lies in the interval, z_f that share.  The leaf's part of the Shapley value of
f is v (o_f - z_f) times the sum over subsets S of the other path features of |S|! (d - |S| - 1)! / d! prod_S o prod_rest z.
As k! (d-1-k)! / d! is the integral of t^k (1 - t)^(d-1-k), that sum is the integral over [0, 1] of
prod (t o_j + (1 - t) z_j), a polynomial of degree d - 1, which Gauss-Legendre quadrature with ceil(d / 2) points gives
exactly.  So no subset is listed and any depth works.

The table is bounded by the model (rounds x 2^depth leaves), not by the data; rows are explained batch by batch where
they lie, with no shuffle.  phi sums to prediction - base for every row, on the margin scale (log-odds for a classifier).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ripplet.operators.boosting import BoostedModel, Tree


@dataclass
class LeafPath:
    value: float
    feature: np.ndarray  # distinct features of the path
    low: np.ndarray      # a row stays on the path if low < x <= high
    high: np.ndarray
    share: np.ndarray


def leaf_paths(tree: Tree, thresholds: np.ndarray) -> list[LeafPath]:
    out, stack = [], [(0, {})]
    while stack:
        node, path = stack.pop()
        f = int(tree.feature[node])
        if f < 0:
            keys = sorted(path)
            low, high, share = (np.array([path[k][i] for k in keys]) for i in range(3))
            out.append(LeafPath(float(tree.value[node]), np.array(keys, int), low, high, share))
            continue
        low, high, share = path.get(f, (-np.inf, np.inf, 1.0))
        cut = thresholds[node]
        for child, interval in ((2 * node + 1, (low, min(high, cut))), (2 * node + 2, (max(low, cut), high))):
            stack.append((child, {**path, f: (*interval, share * tree.cover[child] / tree.cover[node])}))
    return out


def model_paths(model: BoostedModel) -> tuple[list[LeafPath], float]:
    """(leaf paths of all trees, expected value): the base is the cover-weighted mean of the margin."""
    paths, base = [], model.base
    for t in model.trees:
        mine = leaf_paths(t, model.thresholds(t))
        base += sum(p.value * float(np.prod(p.share)) for p in mine)
        paths += [p for p in mine if len(p.feature)]
    return paths, base


def explain_matrix(paths: list[LeafPath], x: np.ndarray) -> np.ndarray:
    """phi of every row and feature."""
    phi, rules = np.zeros(x.shape), {}
    for p in paths:
        d = len(p.feature)
        if d not in rules:
            t, w = np.polynomial.legendre.leggauss((d + 1) // 2)
            rules[d] = (t + 1) / 2, w / 2
        own = x[:, p.feature]
        one = ((own > p.low) & (own <= p.high)).astype(float)
        for t, w in zip(*rules[d]):
            term = t * one + (1 - t) * p.share
            before, after = np.ones_like(term), np.ones_like(term)  # products of the factors on either side: no division
            np.cumprod(term[:, :-1], axis=1, out=before[:, 1:])
            after[:, :-1] = np.cumprod(term[:, :0:-1], axis=1)[:, ::-1]
            phi[:, p.feature] += p.value * w * (one - p.share) * before * after
    return phi


def tree_shap(model: BoostedModel, data: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, base, margin, phi): ``phi`` is an array in the order of ``model.features``."""
    paths, base = model_paths(model)
    features, n = model.features, len(keys)

    def run(batches):
        for b in batches:
            x = model.matrix([b.column(n + j).to_numpy(zero_copy_only=False) for j in range(len(features))])
            phi = explain_matrix(paths, x)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in range(n)), pa.array(np.full(len(x), base)), pa.array(model.margin(x)), pa.array(list(phi), pa.list_(pa.float64()))],
                [*keys, "base", "margin", "phi"])

    chosen = data.select(*keys, *[F.col(c).cast("double").alias(c) for c in features])
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:n])
    return chosen.mapInArrow(run, f"{types}, base double, margin double, phi array<double>")


def shap_importance(values: DataFrame, features: list[str]) -> DataFrame:
    """(feature, mean_abs_shap, mean_shap) over the explained rows."""
    long = values.select(F.posexplode("phi").alias("j", "phi"))
    name = F.element_at(F.array(*[F.lit(f) for f in features]), F.col("j") + 1)
    return long.groupBy(name.alias("feature")).agg(F.avg(F.abs("phi")).alias("mean_abs_shap"), F.avg("phi").alias("mean_shap"))
