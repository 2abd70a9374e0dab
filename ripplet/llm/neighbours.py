"""Approximate nearest neighbours by cosine: stable projections, kd-trees, and a chi-square stopping test.

Vectors are compared on the unit sphere, where the squared distance is 2 - 2 cos.  A Gaussian (2-stable) projection to
``m`` dimensions turns a distance d into a squared projected distance distributed as d^2 chi2(m).  A query therefore
visits points by growing projected distance, verifies them with the true cosine, and stops once the next projected
distance squared exceeds d_k^2 times the ``confidence`` quantile of chi2(m): a point that is nearer than the k-th found
lies beyond that only with probability 1 - confidence.

The index is a kd-tree in two levels.  The upper splits are medians of a sample (``sample`` points of smallest hash; only
the splits depend on it) and route every row to a leaf; a leaf beyond ``leaf_rows`` rows is dealt out over several blocks.
Each block grows its own kd-tree of ``bucket`` points per node.  A query first searches the blocks of its own leaf, then,
with the bound found there, the blocks whose box the stopping test does not rule out.

Equal vectors are one point that carries its k + 1 smallest ids (others can never be among k answers), so a third of
all rows holding one vector is one point; equal query vectors are searched once.

Vectors that are null, zero, or hold null or non-finite components, and rows without an id take no part.  Vectors of
different lengths have no cosine, so every length is a class of its own, with its own projection, splits and blocks.  An
id that repeats with different vectors keeps them all: as a candidate it counts with the nearest, and as a query it asks
with each and every answer has its best score; equal rows count once.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ripplet.session import materialize

SALTS = 64


def chi2_quantile(p: float, m: int) -> float:
    """Quantile of chi-square with an even number of degrees of freedom."""
    def cdf(x):
        return 1 - math.exp(-x / 2) * sum((x / 2) ** j / math.factorial(j) for j in range(m // 2))
    lo, hi = 0.0, 1.0
    while cdf(hi) < p:
        hi *= 2
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if cdf(mid) < p else (lo, mid)
    return hi


def projection(dim: int, m: int, seed: int = 7) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((dim, m))


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def kd_cells(points: np.ndarray, size: int) -> list[np.ndarray]:
    """Index arrays of the leaves of a kd-tree: halves at the median of the widest dimension until ``size`` or fewer."""
    todo, done = [np.arange(len(points))], []
    while todo:
        i = todo.pop()
        if len(i) <= size:
            done.append(i)
            continue
        p = points[i]
        d = int(np.argmax(p.max(axis=0) - p.min(axis=0)))
        half = len(i) // 2
        o = np.argpartition(p[:, d], half)
        todo += [i[o[half:]], i[o[:half]]]
    return done


class Splits:
    """The upper kd-tree: splits learnt on a sample, leaves numbered from the left."""

    def __init__(self, sample: np.ndarray, leaves: int):
        self.nodes: list[tuple] = []  # (dimension, value, left, right) or (leaf number,)
        self.leaves = 0
        self._grow(sample, max(1, leaves))

    def _grow(self, p, want) -> int:
        me = len(self.nodes)
        self.nodes.append(())
        spread = p.max(axis=0) - p.min(axis=0) if len(p) > 1 else np.zeros(1)
        if want <= 1 or len(p) < 2 or not spread.max() > 0:
            self.nodes[me] = (self.leaves,)
            self.leaves += 1
            return me
        d = int(np.argmax(spread))
        left = want // 2
        cut = float(np.quantile(p[:, d], left / want))
        low = p[:, d] <= cut
        if low.all():
            cut = float(np.unique(p[:, d])[-2])
            low = p[:, d] <= cut
        self.nodes[me] = (d, cut, self._grow(p[low], left), self._grow(p[~low], want - left))
        return me

    def route(self, p: np.ndarray) -> np.ndarray:
        out = np.zeros(len(p), np.int32)
        todo = [(0, np.arange(len(p)))]
        while todo:
            k, i = todo.pop()
            node = self.nodes[k]
            if len(node) == 1:
                out[i] = node[0]
            else:
                low = p[i, node[0]] <= node[1]
                todo += [(node[2], i[low]), (node[3], i[~low])]
        return out


def _matrix(column) -> np.ndarray:
    return np.stack([np.asarray(x, np.float64) for x in column]) if len(column) else np.zeros((0, 1))


def box_distance(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances (queries x boxes) to axis-parallel boxes."""
    out = np.zeros((len(q), len(low)))
    for d in range(q.shape[1]):
        x = q[:, d][:, None]
        gap = np.maximum(np.maximum(low[None, :, d] - x, x - high[None, :, d]), 0)
        out += gap * gap
    return out


def search_block(vectors, projected, ids, q, q_projected, bound, k: int, quantile: float, bucket: int = 64, chunk: int = 256):
    """Best (query, id, score) rows of a block: at most ``k`` ids per query.  ``ids``: (points, <= k) with -1 padding after
    the real ones; ``bound``: squared distance of the k-th answer each query already has (inf: none)."""
    cells = kd_cells(projected, bucket)
    low = np.stack([projected[c].min(axis=0) for c in cells])
    high = np.stack([projected[c].max(axis=0) for c in cells])
    width = max(len(c) for c in cells)
    member = np.stack([np.concatenate((c, np.full(width - len(c), c[0]))) for c in cells])
    real = np.stack([np.arange(width) < len(c) for c in cells])
    norm = np.sqrt((vectors * vectors).sum(axis=1))
    twice = len(np.unique(ids[ids >= 0])) < np.count_nonzero(ids >= 0)  # some id has several vectors
    found = []
    for s in range(0, len(q), chunk):
        qv, qp = q[s:s + chunk], q_projected[s:s + chunk]
        q_norm = np.sqrt((qv * qv).sum(axis=1))
        far = box_distance(qp, low, high)
        order = np.argsort(far, axis=1, kind="stable")
        n = len(qv)
        best_score, best_id = np.full((n, k), -np.inf), np.full((n, k), np.iinfo(np.int64).max)
        limit = bound[s:s + chunk].copy()
        live = np.arange(n)
        for r in range(len(cells)):
            cell = order[live, r]
            go = far[live, cell] <= limit[live] * quantile * (1 + 1e-9) + 1e-12
            live, cell = live[go], cell[go]
            if not len(live):
                break
            at = member[cell]
            score = np.einsum("qcd,qd->qc", vectors[at], qv[live]) / (norm[at] * q_norm[live][:, None])
            these = ids[at].reshape(len(live), -1)
            score = np.repeat(np.where(real[cell], score, -np.inf), ids.shape[1], axis=1)
            score[these < 0] = -np.inf
            score = np.concatenate((best_score[live], score), axis=1)
            these = np.concatenate((best_id[live], np.where(np.isneginf(score[:, k:]), np.iinfo(np.int64).max, these)), axis=1)
            if twice:  # the best of each id counts
                order_by_id = np.lexsort((-score, these), axis=1)
                score, these = np.take_along_axis(score, order_by_id, 1), np.take_along_axis(these, order_by_id, 1)
                again = np.zeros(these.shape, bool)
                again[:, 1:] = these[:, 1:] == these[:, :-1]
                score[again], these[again] = -np.inf, np.iinfo(np.int64).max
            top = np.lexsort((these, -score), axis=1)[:, :k]
            best_score[live], best_id[live] = np.take_along_axis(score, top, 1), np.take_along_axis(these, top, 1)
            limit[live] = np.minimum(limit[live], 2 - 2 * best_score[live, k - 1])
        row, col = np.nonzero(best_score > -np.inf)
        found.append((row + s, best_id[row, col], best_score[row, col]))
    return tuple(np.concatenate(x) for x in zip(*found))


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(vec_id, v) of the rows that take part."""
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()
                      & F.forall("v", lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)) & ~F.isnan(F.coalesce(x, F.lit(0.0))))
                      & F.exists("v", lambda x: x != 0))
    return rows.distinct()


def nearest_neighbours(vectors: DataFrame, is_query, k: int = 5, id_column: str = "vec_id", vector_column: str = "embedding", m: int = 8,
                       confidence: float = 0.97, leaf_rows: int = 20_000, sample: int = 8192, bucket: int = 64) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest found for every row where ``is_query`` (a condition on vec_id)."""
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = materialize(usable(vectors, id_column, vector_column), "ann-rows")
    # the k + 1 smallest ids of every distinct vector, first within salts
    salted = Window.partitionBy("v", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS))).orderBy("vec_id")
    whole = Window.partitionBy("v").orderBy("vec_id")
    few = (rows.withColumn("n", F.row_number().over(salted)).where(F.col("n") <= k + 1)
           .withColumn("n", F.row_number().over(whole)).where(F.col("n") <= k + 1))
    points = few.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))

    def project(batches):
        for pdf in batches:
            if len(pdf):
                sizes, out = pdf["v"].map(len).to_numpy(), np.empty((len(pdf), m))
                for dim in np.unique(sizes):
                    at = np.flatnonzero(sizes == dim)
                    out[at] = unit(_matrix(pdf["v"].iloc[at])) @ projection(int(dim), m)
                pdf["p"] = list(out)
                yield pdf
    points = materialize(points.mapInPandas(project, "v array<double>, ids array<long>, p array<double>"), "ann-points")
    totals = {r.dim: r.n for r in points.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n")).orderBy("dim").collect()}  # a row for each length
    if not totals:
        return empty
    splits, offset, leaves = {}, {}, 0
    for dim, total in totals.items():
        some = points.where(F.size("v") == dim).select("p").orderBy(F.xxhash64(F.element_at("ids", 1)), F.element_at("ids", 1)).limit(sample)
        # one leaf needs no sample
        splits[dim] = Splits(_matrix(some.toPandas()["p"]) if total > leaf_rows else np.zeros((0, m)), min(4096, -(-total // leaf_rows)))
        offset[dim], leaves = leaves, leaves + splits[dim].leaves
    dim_of = np.repeat(list(offset), [splits[dim].leaves for dim in offset])  # by leaf

    def route(batches):
        for pdf in batches:
            if len(pdf):
                sizes, out = pdf["v"].map(len).to_numpy(), np.empty(len(pdf), np.int32)
                for dim in np.unique(sizes).tolist():
                    at = np.flatnonzero(sizes == dim)
                    out[at] = offset[dim] + splits[dim].route(_matrix(pdf["p"].iloc[at]))
                pdf["leaf"] = out
                yield pdf
    routed = points.mapInPandas(route, "v array<double>, ids array<long>, p array<double>, leaf int")
    stats = (routed.groupBy("leaf").agg(F.count("*").alias("n"), *[F.min(F.col("p")[d]).alias(f"lo{d}") for d in range(m)],
                                        *[F.max(F.col("p")[d]).alias(f"hi{d}") for d in range(m)]).orderBy("leaf").toPandas())  # at most 4,096 rows a length
    parts = {int(a): max(1, -(-int(n) // leaf_rows)) for a, n in zip(stats["leaf"], stats["n"])}
    share = F.create_map(*[F.lit(x) for kv in parts.items() for x in kv]) if len(parts) <= 64 else None
    shares = spark.createDataFrame(list(parts.items()), "leaf int, parts int")
    routed = routed.withColumn("parts", share[F.col("leaf")]) if share is not None else routed.join(F.broadcast(shares), "leaf")
    blocks = materialize(routed.withColumn("part", F.pmod(F.xxhash64(F.element_at("ids", 1)), F.col("parts")).cast("int"))
                         .select("leaf", "part", "v", "ids", "p"), "ann-blocks")
    low, high = (stats[[f"{s}{d}" for d in range(m)]].to_numpy() for s in ("lo", "hi"))
    leaf_of = stats["leaf"].to_numpy()
    quantile = chi2_quantile(confidence, m)

    queries = rows.where(is_query).select("v").distinct().select(F.monotonically_increasing_id().alias("q"), "v")  # kept by the write
    queries = queries.mapInPandas(project, "q long, v array<double>, p array<double>").mapInPandas(route, "q long, v array<double>, p array<double>, leaf int")
    queries = materialize(queries.withColumn("bound", F.lit(float("inf"))), "ann-queries")

    def search(key, block: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(block) or not len(asked):
            return pd.DataFrame({"q": [], "vec_id": [], "score": []})
        ids = np.full((len(block), k + 1), -1, np.int64)
        for i, x in enumerate(block["ids"]):
            ids[i, :len(x)] = x
        valid = np.array([len(x) for x in block["ids"]])[:, None] > np.arange(k + 1)
        # ids may be any long: search by their rank in the block, and translate at the end
        place = np.full(ids.shape, -1, np.int64)
        known, place[valid] = np.unique(ids[valid], return_inverse=True)
        q, got, score = search_block(_matrix(block["v"]), _matrix(block["p"]), place, _matrix(asked["v"]), _matrix(asked["p"]),
                                     asked["bound"].to_numpy(np.float64), k + 1, quantile, bucket)
        return pd.DataFrame({"q": asked["q"].to_numpy()[q], "vec_id": known[got], "score": score})

    def run(asked):
        """Queries (q, v, p, leaf, bound) against all parts of their leaf."""
        dealt = asked.join(F.broadcast(shares), "leaf").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        return blocks.groupBy("leaf", "part").cogroup(dealt.groupBy("leaf", "part")).applyInPandas(search, "q long, vec_id long, score double")

    best = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    home = materialize(run(queries).groupBy("q", "vec_id").agg(F.max("score").alias("score")).withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1), "ann-home")
    bound = home.groupBy("q").agg(F.max(F.when(F.col("n") == k + 1, 2 - 2 * F.col("score"))).alias("found"))

    def reach(batches):
        for pdf in batches:
            if len(pdf):
                near = box_distance(_matrix(pdf["p"]), low, high) <= pdf["bound"].to_numpy(np.float64)[:, None] * quantile * (1 + 1e-9) + 1e-12
                near &= (pdf["leaf"].to_numpy()[:, None] != leaf_of[None, :]) & (pdf["v"].map(len).to_numpy()[:, None] == dim_of[leaf_of][None, :])
                i, j = np.nonzero(near)
                yield pdf.iloc[i].assign(leaf=leaf_of[j].astype(np.int32))
    asked = queries.drop("bound").join(bound, "q", "left").withColumn("bound", F.coalesce("found", F.lit(float("inf")))).select("q", "v", "p", "leaf", "bound")
    away = run(asked.mapInPandas(reach, "q long, v array<double>, p array<double>, leaf int, bound double"))
    merged = home.select("q", "vec_id", "score").unionByName(away).groupBy("q", "vec_id").agg(F.max("score").alias("score")).withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1)
    each = rows.where(is_query).select(F.col("vec_id").alias("query_id"), "v").join(queries.select("q", "v"), "v").select("query_id", "q")
    own = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (each.join(merged.select("q", "vec_id", "score"), "q").where("query_id <> vec_id")
            .groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
            .withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))
