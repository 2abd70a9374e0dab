"""Exact k-nearest-neighbour join (F6) and the oversamplers built on it.

Pivot (Voronoi) partitioning with triangle-inequality bounds (Lu et al., 2012): references belong to the cell of their nearest
pivot, and a query is sent only to cells that can hold one of its neighbours.

1. At most MAX_PIVOTS references, drawn by hash, are the pivots (bounded, kept by the driver and sent with the tasks).
2. Every reference gets its cell; a cell's radius and size are one aggregate row a cell.
3. A query first visits its nearest cells until they hold k references.  The distance of the k-th found bounds the rest.
4. It then visits only cells whose distance to it can be within that bound: d(q, p) - radius, and the distance to the
   plane between the cell's pivot and its own, are lower bounds.

Cells are cut into blocks of at most ``block_rows`` references and queries by hash, so a hot cell (or a third of all
vectors equal) is many groups.  A group evaluates its distances with numpy and emits its own top k per query; a
per-query window merges them (ties broken by reference id).  Nothing is approximate.

SMOTE / ADASYN draw seeds, neighbours and gaps with the portable hash (X4),
so the synthetic set is reproducible and independent of partitioning.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ripplet.functions.random import dense_index, hash60_sql, uniform_sql
from ripplet.session import materialize

BLOCK_ROWS = 4096
STEP = 256  # queries per distance matrix: 256 x 4096 doubles are 8 MB
MAX_PIVOTS = 1024
SLACK = 1e-9  # relative rounding error left to the bounds


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.map(lambda a: np.asarray(a, dtype=np.float64)).to_numpy())


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    near = (x * x).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1)[None, :] - 2.0 * (x @ pivots.T)
    return np.sqrt(np.maximum(near, 0.0))


def _top_k(k: int, exclude_self: bool):
    """Group function: the k nearest references of the group for each of its queries."""
    def topk(pdf: pd.DataFrame) -> pd.DataFrame:
        qs, rs = pdf[pdf.side == 0], pdf[pdf.side == 1]
        if qs.empty or rs.empty:
            return pd.DataFrame({"qid": [], "rid": [], "dist": []})
        Q, R = _matrix(qs.v), _matrix(rs.v)
        qi, ri = qs.id.to_numpy(), rs.id.to_numpy()
        out = []
        r2 = (R * R).sum(axis=1)
        for s in range(0, len(Q), STEP):  # (STEP, block_rows) distances at a time
            q, ids = Q[s:s + STEP], qi[s:s + STEP]
            near = (q * q).sum(axis=1)[:, None] + r2[None, :] - 2.0 * (q @ R.T)
            skip = ids[:, None] == ri[None, :] if exclude_self else None
            if skip is not None:
                near[skip] = np.inf
            kk = min(k, near.shape[1])
            # |q|^2 + |r|^2 - 2 q.r only picks candidates: everything within its rounding error of the k-th
            # stays (all ties with it), and is scored again by exact differences.
            cut = np.partition(near, kk - 1, axis=1)[:, kk - 1]
            slack = 1e-9 * ((q * q).sum(axis=1) + r2.max()) + 1e-300
            row, col = np.nonzero(near <= np.where(np.isfinite(cut), cut + slack, np.finfo(float).max)[:, None])
            dist = np.sqrt(((q[row] - R[col]) ** 2).sum(axis=1))
            o = np.lexsort((ri[col], dist, row))
            row, col, dist = row[o], col[o], dist[o]
            first = np.searchsorted(row, np.arange(len(q)))
            keep = np.arange(len(row)) - first[row] < k
            out.append((ids[row[keep]], ri[col[keep]], dist[keep]))
        q_, r_, d_ = (np.concatenate(x) for x in zip(*out))
        return pd.DataFrame({"qid": q_, "rid": r_, "dist": d_})
    return topk


def choose_pivots(refs: DataFrame, n_refs: int) -> np.ndarray:
    """About sqrt(n) references of smallest hash, at most MAX_PIVOTS; equal vectors count once."""
    p = max(1, min(MAX_PIVOTS, int(math.sqrt(n_refs))))
    rows = refs.select("v").orderBy(F.xxhash64("id"), "id").limit(p).collect()
    return np.unique(np.array([r["v"] for r in rows], float), axis=0)


def _visits(x: np.ndarray, own: np.ndarray, pivots: np.ndarray, radius: np.ndarray, size: np.ndarray, k: int, bound: np.ndarray | None):
    """(row, cell) of the cells a batch of queries goes to: the first ones (``bound`` None), or those left within the bound."""
    d = own
    order = np.argsort(np.where(size[None, :] > 0, d, np.inf), axis=1, kind="stable")
    before = np.cumsum(size[order], axis=1) - size[order]
    first = np.zeros(d.shape, bool)
    np.put_along_axis(first, order, (before < k) & (size[order] > 0), axis=1)
    if bound is None:
        return np.nonzero(first)
    home = order[:, 0]
    gap = _distances(pivots, pivots)
    with np.errstate(divide="ignore", invalid="ignore"):
        plane = (d ** 2 - d[np.arange(len(x)), home][:, None] ** 2) / (2 * gap[home])
    plane[~np.isfinite(plane)] = -np.inf
    low = np.maximum(d - radius[None, :], plane)
    scale = 1 + bound[:, None] + d
    return np.nonzero((low <= bound[:, None] + SLACK * scale ** 2) & ~first & (size[None, :] > 0))


def _evaluate(queries: DataFrame, visits: DataFrame, refs: DataFrame, sizes: np.ndarray, k: int, exclude_self: bool, block_rows: int) -> DataFrame:
    """Top k of each (query, visited cell block).  ``visits``: (id, v, cell); ``refs``: (id, v, cell)."""
    spark = refs.sparkSession
    asked = {r["cell"]: r["count"] for r in visits.groupBy("cell").count().collect()}  # a row a cell
    cells = [(int(c), max(1, -(-int(sizes[c]) // block_rows)), max(1, -(-int(n) // block_rows))) for c, n in asked.items()]
    blocks = F.broadcast(spark.createDataFrame(cells, "cell int, rbs int, qbs int"))  # bounded by MAX_PIVOTS rows
    q = (visits.join(blocks, "cell").withColumn("qb", F.pmod(F.xxhash64("id"), F.col("qbs")).cast("int"))
         .withColumn("rb", F.explode(F.sequence(F.lit(0), F.col("rbs") - 1))))
    r = (refs.join(blocks, "cell").withColumn("rb", F.pmod(F.xxhash64("id"), F.col("rbs")).cast("int"))
         .withColumn("qb", F.explode(F.sequence(F.lit(0), F.col("qbs") - 1))))
    part = ["cell", "qb", "rb"]
    both = q.select("id", "v", *part, F.lit(0).alias("side")).unionByName(r.select("id", "v", *part, F.lit(1).alias("side")))
    return both.groupBy(*part).applyInPandas(_top_k(k, exclude_self), "qid long, rid long, dist double")


def knn_join(queries: DataFrame, refs: DataFrame, k: int, q_id: str = "qid", r_id: str = "rid",
             vec: str = "vec", exclude_self: bool = False, block_rows: int = BLOCK_ROWS, log: list | None = None) -> DataFrame:
    """(qid, rid, dist, rank) for the k nearest references of every query (Euclidean; ``exclude_self`` drops rid == qid).
    ``log`` receives the (query, cell) visits of both rounds, as DataFrames."""
    vec_of = lambda df, name: df.select(F.col(name).cast("long").alias("id"), F.col(vec).cast("array<double>").alias("v"))
    q, r = vec_of(queries, q_id), vec_of(refs, r_id)
    n_refs = r.count()
    w = Window.partitionBy("qid").orderBy("dist", "rid")
    if n_refs == 0:
        return q.where("false").select(F.col("id").alias("qid"), F.col("id").alias("rid"), F.lit(0.0).alias("dist"), F.lit(1).alias("rank"))
    pivots = choose_pivots(r, n_refs)

    def assign(batches):
        for pdf in batches:
            for s in range(0, len(pdf), STEP):
                part = pdf.iloc[s:s + STEP]
                d = _distances(_matrix(part["v"]), pivots)
                yield part.assign(cell=d.argmin(axis=1).astype(np.int32), far=d.min(axis=1))

    placed = materialize(r.mapInPandas(assign, "id long, v array<double>, cell int, far double"), "knn-refs")
    radius, size = np.zeros(len(pivots)), np.zeros(len(pivots), np.int64)
    for row in placed.groupBy("cell").agg(F.max("far").alias("far"), F.count("*").alias("n")).collect():  # a row a cell
        radius[row["cell"]], size[row["cell"]] = row["far"], row["n"]
    need = k + 1 if exclude_self else k

    def visiting(with_bound: bool):
        def run(batches):
            for pdf in batches:
                for s in range(0, len(pdf), STEP):
                    part = pdf.iloc[s:s + STEP]
                    x = _matrix(part["v"])
                    i, cell = _visits(x, _distances(x, pivots), pivots, radius, size, need, part["bound"].to_numpy() if with_bound else None)
                    yield pd.DataFrame({"id": part["id"].to_numpy()[i], "v": part["v"].to_numpy()[i], "cell": cell.astype(np.int32)})
        return run

    shape = "id long, v array<double>, cell int"
    first = materialize(q.mapInPandas(visiting(False), shape), "knn-first")
    near = materialize(_evaluate(q, first, placed, size, k, exclude_self, block_rows), "knn-near")
    rank = F.row_number().over(w)
    bound = near.withColumn("rank", rank).where(F.col("rank") <= k).groupBy(F.col("qid").alias("id")).agg(
        F.max("dist").alias("bound"), F.count("*").alias("found"))
    # fewer than k found (the query's copies of itself aside) means no bound at all
    bounded = q.join(bound, "id", "left").select("id", "v", F.when(F.col("found") >= k, F.col("bound")).otherwise(F.lit(math.inf)).alias("bound"))
    second = materialize(bounded.mapInPandas(visiting(True), shape), "knn-second")
    if log is not None:
        log += [first.select("id", "cell"), second.select("id", "cell"), size]
    cand = near.unionByName(_evaluate(q, second, placed, size, k, exclude_self, block_rows))
    return cand.withColumn("rank", rank).where(F.col("rank") <= k)


def knn_predict(queries: DataFrame, refs: DataFrame, k: int = 15, id_col: str = "vec_id",
                vec: str = "embedding", label: str = "label") -> DataFrame:
    """uniform-weight kNN classifier (majority label, ties -> smallest
    label) and the neighbours' mean label (the regressor form)."""
    nn = knn_join(queries.select(F.col(id_col).alias("qid"), F.col(vec).alias("vec")),
                  refs.select(F.col(id_col).alias("rid"), F.col(vec).alias("vec")), k)
    lab = refs.select(F.col(id_col).alias("rid"), F.col(label).alias("_y"))
    v = nn.join(lab, "rid").groupBy("qid", "_y").agg(F.count(F.lit(1)).alias("votes"))
    w = Window.partitionBy("qid").orderBy(F.desc("votes"), "_y")
    pred = v.withColumn("_r", F.row_number().over(w)).where("_r = 1").select("qid", F.col("_y").alias("pred"))
    mean = nn.join(lab, "rid").groupBy("qid").agg(F.avg(F.col("_y").cast("double")).alias("mean_label"))
    truth = queries.select(F.col(id_col).alias("qid"), F.col(label).alias("label"))
    return truth.join(pred, "qid").join(mean, "qid").withColumnRenamed("qid", id_col)


def smote(train: DataFrame, k: int = 5, seed: int = 42, id_col: str = "vec_id", vec: str = "embedding",
          label: str = "y") -> DataFrame:
    """G1: add n_maj - n_min synthetic minority points x_s + u (x_nn - x_s),
    seed s and neighbour (one of its k nearest minority points) and gap
    u ~ U(0, 1) drawn from the hash of the synthetic id."""
    counts = {r[label]: r["n"] for r in train.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return train.limit(0).select(F.lit(None).cast("long").alias("synthetic_id"), F.col(vec), F.col(label),
                                     F.col(id_col).alias("seed_id"), F.col(id_col).alias("neighbour_id"), F.lit(0.0).alias("u"))
    minority = min(counts, key=lambda c: (counts[c], c))
    g = max(counts.values()) - counts[minority]
    mino = train.where(F.col(label) == minority)
    nn = knn_join(mino.select(F.col(id_col).alias("qid"), F.col(vec).alias("vec")),
                  mino.select(F.col(id_col).alias("rid"), F.col(vec).alias("vec")), k, exclude_self=True)
    # Dense minority index for hash-drawn seeds.
    n_min = counts[minority]
    seeds = dense_index(mino.select(id_col, vec), id_col, n_min)
    spark = train.sparkSession
    syn = spark.range(g).withColumnRenamed("id", "synthetic_id")
    if n_min < 2:  # a lone minority point has no neighbour to interpolate towards
        return train.limit(0).select(F.lit(None).cast("long").alias("synthetic_id"), F.col(vec), F.col(label),
                                     F.col(id_col).alias("seed_id"), F.col(id_col).alias("neighbour_id"), F.lit(0.0).alias("u"))
    syn = syn.withColumns({"_i": F.expr(f"{hash60_sql(str(seed), 'synthetic_id', '1')} % {n_min}"),
                           "rank": F.expr(f"{hash60_sql(str(seed), 'synthetic_id', '2')} % {min(k, n_min - 1)}") + 1,
                           "u": F.expr(uniform_sql(str(seed), "synthetic_id", "3"))})
    s = syn.join(seeds, "_i").join(nn.select(F.col("qid").alias(id_col), "rid", "rank"), [id_col, "rank"])
    nbv = mino.select(F.col(id_col).alias("rid"), F.col(vec).alias("_nv"))
    s = s.join(nbv, "rid")
    new = F.zip_with(vec, "_nv", lambda a, b: a + F.col("u") * (b - a))
    return s.select("synthetic_id", new.alias(vec), F.lit(minority).alias(label), F.col(id_col).alias("seed_id"),
                    F.col("rid").alias("neighbour_id"), "u")


def adasyn(train: DataFrame, k: int = 5, seed: int = 42, id_col: str = "vec_id", vec: str = "embedding",
           label: str = "y") -> DataFrame:
    """Minority weights r_i = share of majority points among the k nearest
    neighbours in all data; g_i = round(r_i / sum r * G); each synthetic
    point interpolates toward a hash-drawn one of the k nearest minority
    points.  Returns an explicit 'not applicable' row when nothing is generated."""
    counts = {r[label]: r["n"] for r in train.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    spark = train.sparkSession
    na = spark.createDataFrame([("not applicable",)], "status string")
    if len(counts) < 2:
        return na
    minority = min(counts, key=lambda c: (counts[c], c))
    G = max(counts.values()) - counts[minority]
    mino = train.where(F.col(label) == minority)
    allq = knn_join(mino.select(F.col(id_col).alias("qid"), F.col(vec).alias("vec")),
                    train.select(F.col(id_col).alias("rid"), F.col(vec).alias("vec")), k, exclude_self=True)
    lab = train.select(F.col(id_col).alias("rid"), F.col(label).alias("_y"))
    r = allq.join(lab, "rid").groupBy("qid").agg((F.count_if(F.col("_y") != minority) / F.lit(float(k))).alias("r"))
    tot = r.agg(F.sum("r").alias("s")).first()["s"] or 0.0
    if G == 0 or tot == 0:
        return na
    gi = r.withColumn("g", F.round(F.col("r") / F.lit(tot) * F.lit(float(G))).cast("int")).where("g > 0")
    nn = knn_join(mino.select(F.col(id_col).alias("qid"), F.col(vec).alias("vec")),
                  mino.select(F.col(id_col).alias("rid"), F.col(vec).alias("vec")), k, exclude_self=True)
    gen = gi.select(F.col("qid").alias(id_col), F.explode(F.sequence(F.lit(0), F.col("g") - 1)).alias("s"))
    if counts[minority] < 2:
        return na
    gen = gen.withColumns({"rank": F.expr(f"{hash60_sql(str(seed), id_col, 's')} % {min(k, counts[minority] - 1)}") + 1,
                           "u": F.expr(uniform_sql(str(seed), id_col, "s + 100000"))})
    gen = gen.join(nn.select(F.col("qid").alias(id_col), "rid", "rank"), [id_col, "rank"])
    gen = gen.join(mino.select(id_col, vec), id_col).join(
        mino.select(F.col(id_col).alias("rid"), F.col(vec).alias("_nv")), "rid")
    new = F.zip_with(vec, "_nv", lambda a, b: a + F.col("u") * (b - a))
    return gen.select(F.lit("generated").alias("status"), F.col(id_col).alias("seed_id"),
                      F.col("rid").alias("neighbour_id"), "u", new.alias(vec), F.lit(minority).alias(label))
