"""Small dense least squares per group.

The O(n) part — the Gram matrix X'X and X'y — is one aggregation on
executors (sums of products).  Each group's (k x k) system (k is a model
order, not data-sized) is solved by ``applyInPandas`` with numpy on one row
per group, so many groups solve in parallel and nothing passes the driver."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def gram(df: DataFrame, keys: list[str], xs: list[Column], y: Column) -> DataFrame:
    """Per group: n, X'X (row-major, k*k) and X'y as arrays; rows with a NULL dropped."""
    k = len(xs)
    ok = y.isNotNull()
    for x in xs:
        ok = ok & x.isNotNull()
    d = df.where(ok).select(*keys, *[x.cast("double").alias(f"_x{i}") for i, x in enumerate(xs)],
                            y.cast("double").alias("_y"))
    aggs = [F.count(F.lit(1)).alias("n")]
    aggs += [F.sum(F.col(f"_x{i}") * F.col(f"_x{j}")).alias(f"_g{i}_{j}") for i in range(k) for j in range(k)]
    aggs += [F.sum(F.col(f"_x{i}") * F.col("_y")).alias(f"_b{i}") for i in range(k)]
    g = d.groupBy(*keys).agg(*aggs)
    return g.select(*keys, "n", F.array(*[F.col(f"_g{i}_{j}") for i in range(k) for j in range(k)]).alias("xtx"),
                    F.array(*[F.col(f"_b{i}") for i in range(k)]).alias("xty"))


def solve(g: DataFrame, keys: list[str]) -> DataFrame:
    """Coefficients per group (least-squares solve of X'X b = X'y)."""
    key_schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in g.schema.fields if f.name in keys)

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, r in pdf.iterrows():
            b = np.asarray(r["xty"], dtype=float)
            a = np.asarray(r["xtx"], dtype=float).reshape(len(b), len(b))
            coef = np.linalg.lstsq(a, b, rcond=None)[0]
            out.append({**{k: r[k] for k in keys}, "coef": coef.tolist()})
        return pd.DataFrame(out, columns=keys + ["coef"])

    return g.groupBy(*keys).applyInPandas(fn, f"{key_schema}, coef array<double>")


def solve_ridge(g: DataFrame, keys: list[str], alpha: float, free: tuple[int, ...] = (0,)) -> DataFrame:
    """(X'WX + alpha I) b = X'Wy per group, leaving the ``free`` (intercept)
    coefficients unpenalised."""
    key_schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in g.schema.fields if f.name in keys)

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, r in pdf.iterrows():
            b = np.asarray(r["xty"], dtype=float)
            a = np.asarray(r["xtx"], dtype=float).reshape(len(b), len(b))
            pen = np.full(len(b), alpha)
            pen[list(free)] = 0.0
            coef = np.linalg.lstsq(a + np.diag(pen), b, rcond=None)[0]
            out.append({**{k: r[k] for k in keys}, "coef": coef.tolist()})
        return pd.DataFrame(out, columns=keys + ["coef"])

    return g.groupBy(*keys).applyInPandas(fn, f"{key_schema}, coef array<double>")


def weighted_gram(df: DataFrame, keys: list[str], xs: list[Column], y: Column, w: Column) -> DataFrame:
    """Per group: X'WX and X'Wy (row-major arrays)."""
    k = len(xs)
    d = df.select(*keys, *[x.cast("double").alias(f"_x{i}") for i, x in enumerate(xs)],
                  y.cast("double").alias("_y"), w.cast("double").alias("_w"))
    aggs = [F.sum(F.col("_w") * F.col(f"_x{i}") * F.col(f"_x{j}")).alias(f"_g{i}_{j}")
            for i in range(k) for j in range(k)]
    aggs += [F.sum(F.col("_w") * F.col(f"_x{i}") * F.col("_y")).alias(f"_b{i}") for i in range(k)]
    g = d.groupBy(*keys).agg(*aggs)
    return g.select(*keys, F.array(*[F.col(f"_g{i}_{j}") for i in range(k) for j in range(k)]).alias("xtx"),
                    F.array(*[F.col(f"_b{i}") for i in range(k)]).alias("xty"))
