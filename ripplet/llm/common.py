"""Helpers shared by the operators: flat views of Arrow text, bounded chunks, and distributed union-find."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ripplet.session import materialize

CHUNK_BYTES = 1 << 21  # text handled at once inside a task; bounds the memory of the numpy arrays


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def flat_text(col) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null is empty.  A view of the Arrow buffers where possible."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    col = col.cast(pa.large_binary())
    n = len(col)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, np.int64)[col.offset:col.offset + n + 1]
    flat = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return flat, offsets - offsets[0]


def row_chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most ``limit`` bytes (a longer row stands alone)."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(n, max(j, i + 1))
        yield i, j
        i = j


class BitTable:
    """Fixed-size table of hash positions, broadcast to thin out a scan before a join: every member passes, others only by
    collision.  Its size does not grow with the data; a table that fills up lets more pass, never less."""

    def __init__(self, session, table: np.ndarray):
        self.table = session.sparkContext.broadcast(table)

    @staticmethod
    def of(positions: DataFrame, bits: int) -> BitTable:
        """Table of the column ``at`` (0 <= at < 2^bits); at most 2^(bits - 5) rows of 32 positions are collected."""
        got = (positions.select(F.shiftright("at", 5).alias("word"), F.pmod("at", F.lit(32)).cast("int").alias("bit"))
               .groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("mask")).toPandas())
        table = np.zeros(1 << (bits - 5), np.uint32)
        table[got["word"].to_numpy(np.int64)] = got["mask"].to_numpy(np.int64).astype(np.uint32)
        return BitTable(positions.sparkSession, table)

    @staticmethod
    def of_segments(segments: DataFrame, bits: int) -> BitTable:
        """Table of (part, segment) rows: each part's whole share of the table as bytes; 2^(bits - 3) bytes are collected."""
        table = np.zeros(1 << (bits - 3), np.uint8)
        for part, segment in segments.select("part", "segment").toLocalIterator():
            table[part * len(segment):(part + 1) * len(segment)] = np.frombuffer(bytes(segment), np.uint8)
        return BitTable(segments.sparkSession, table.view(np.uint32))

    @staticmethod
    def test(table: np.ndarray, at: np.ndarray) -> np.ndarray:
        return (table[at >> 5] >> (at & 31).astype(np.uint32)) & np.uint32(1) == 1


def local_components(n: int, u: np.ndarray, v: np.ndarray, parent: np.ndarray | None = None) -> np.ndarray:
    """Union-find over the vertices 0..n-1 of one task: every vertex gets the smallest index of its component."""
    p = np.arange(n) if parent is None else parent
    while len(u):
        ru, rv = p[u], p[v]
        live = ru != rv
        if not live.any():
            break
        u, v, ru, rv = u[live], v[live], ru[live], rv[live]
        np.minimum.at(p, np.maximum(ru, rv), np.minimum(ru, rv))
        while True:
            q = p[p]
            if np.array_equal(q, p):
                break
            p[:] = q
    return p


ONE_TASK_EDGES = 500_000


def _forest(pdf: pd.DataFrame) -> pd.DataFrame:
    names = sorted(set(pdf["u"]) | set(pdf["v"]))
    number = {x: i for i, x in enumerate(names)}
    p = local_components(len(names), pdf["u"].map(number).to_numpy(np.int64), pdf["v"].map(number).to_numpy(np.int64))
    return pd.DataFrame({"id": names, "root": [names[i] for i in p.tolist()]})


def connected_components(edges: DataFrame, name: str, one_task: int = ONE_TASK_EDGES) -> DataFrame:
    """Distributed union-find.  ``edges``: (a, b), longs or any ordered type; returns (id, root) with the
    smallest reachable id, for every id that has an edge.

    Alternates the large-star and small-star steps until the forest stands still (O(log^2 n) rounds).  Each step
    is a min-aggregation with map-side combine and an equi-join, so a hot vertex is a skewed join key that adaptive
    execution splits; every round is written to the shared checkpoint folder and read again.  What fits in one task by
    its count (``one_task`` edges) is finished there by a local union-find."""
    cur = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u"))
                      .distinct(), f"{name}-cc")
    kind = cur.schema["u"].dataType.simpleString()
    stamp = None
    while True:
        if cur.count() <= one_task:
            return cur.withColumn("one", F.lit(0)).groupBy("one").applyInPandas(_forest, f"id {kind}, root {kind}")
        both = cur.select("u", "v").union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select("v", F.col("m").alias("u")).where("v <> u").distinct()
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = (large.join(least, "v").select(F.explode(F.array(F.struct(F.col("u").alias("v"), F.col("m").alias("u")),
                                                                 F.struct("v", F.col("m").alias("u")))).alias("e"))
                 .select("e.v", "e.u").where("v <> u").distinct())
        cur = materialize(small, f"{name}-cc")
        now = cur.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if stamp == tuple(now):
            break
        stamp = tuple(now)
    roots = cur.select(F.col("v").alias("id"), F.col("u").alias("root"))
    return roots.union(cur.select(F.col("u").alias("id"), F.col("u").alias("root")).distinct())
