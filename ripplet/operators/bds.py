"""BDS independence test (J5), Broock, Dechert, Scheinkman & LeBaron (1996).

Per series (symbol, model) with eps = 0.5 * population std:
  P    = {(i, j): i < j, |x_i - x_j| < eps}
  C1   = |P| / (n(n-1)/2);  K from row sums r_i = 1 + deg_i
  C_m  = #{(i, j) in P: i >= m-1 and (i-k, j-k) in P for k < m} / ((n-m+1)(n-m)/2)
  C1_m = #{(i, j) in P: i >= m-1} / ((n-m+1)(n-m)/2)
  V_m  = 4 [K^m + 2 sum_{j=1}^{m-1} K^{m-j} C1^{2j} + (m-1)^2 C1^{2m} - m^2 K C1^{2m-2}]
  W_m  = sqrt(n-m+1) (C_m - C1_m^m) / sqrt(V_m),  p = erfc(|W| / sqrt 2)

No pair is ever a row.  A series is cut into time blocks of B values; a task gets two blocks (each with the m - 1 values
before it), makes their B x B indicator matrix, ANDs it with itself shifted along the diagonal for each dimension, and
returns counts plus the close neighbours of every position of the two blocks.  Those vectors are added up per block for
K.  What is shuffled is the series once per block row (n^2 / B values), what comes back 2 B numbers a block pair.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ripplet.functions.special import normal_two_sided_p_sql
from ripplet.operators.residuals import residual_table
from ripplet.session import materialize

BLOCK = 2048  # an indicator matrix of two blocks is 4 MB


def block_counts(lo: np.ndarray, hi: np.ndarray, eps: float, before: tuple[int, int], same: bool, max_dim: int) -> tuple[list[int], list[int], np.ndarray, np.ndarray]:
    """Of two time blocks, each led by ``before`` values of its predecessor: pairs close in 1..m steps (``close[m - 1]``),
    pairs whose later position has m - 1 values before it (``able``), and each position's number of close partners."""
    b0, b1 = before
    near = np.abs(lo[:, None] - hi[None, :]) < eps
    own = near[b0:, b1:]
    upper = np.triu(own, 1) if same else own
    close, able = [int(upper.sum())], [int(upper.sum())]
    both = near
    for m in range(2, max_dim + 1):
        both = both[1:, 1:] & near[:max(both.shape[0] - 1, 0), :max(both.shape[1] - 1, 0)]  # [i, j] of ``near`` and its m - 1 predecessors
        skip = (max(0, b0 - (m - 1)), max(0, b1 - (m - 1)))
        part = both[skip[0]:, skip[1]:]
        close.append(int((np.triu(part, 1) if same else part).sum()))
        first = max(0, (m - 1) - b0)  # positions of the series with fewer than m - 1 predecessors
        able.append(int(upper[first:].sum()))
    own_pairs = own.diagonal() if same else 0  # a position is no partner of itself; where eps is 0 it is not even close
    return close, able, own.sum(axis=1) - own_pairs, own.sum(axis=0)


def bds_test(series: DataFrame, keys: list[str], max_dim: int = 3, block: int = BLOCK) -> DataFrame:
    """``series``: (keys, t, x) with t = 0..n-1.  One row per (keys, dim)."""
    keys, lead = list(keys), max_dim - 1
    wk = Window.partitionBy(*keys)
    s = series.select(*keys, "t", "x").withColumns({"n": F.count(F.lit(1)).over(wk), "eps": 0.5 * F.stddev_pop("x").over(wk),
                                                    "b": F.floor(F.col("t") / block).cast("int")})
    blocks = s.groupBy(*keys, "n", "eps", "b").agg(F.transform(F.array_sort(F.collect_list(F.struct("t", "x"))), lambda r: r["x"]).alias("xs"))
    prior = F.lag("xs").over(wk.orderBy("b"))
    tail = F.when(prior.isNull(), F.array().cast("array<double>")).otherwise(F.slice(prior, -F.least(F.lit(lead), F.size(prior)), lead))
    blocks = materialize(blocks.withColumns({"before": F.size(tail), "ys": F.concat(tail, "xs")}).drop("xs"), "bds-blocks")
    last = F.floor((F.col("n") - 1) / block).cast("int")
    dealt = (blocks.withColumn("c", F.explode(F.sequence(F.lit(0), last)))
             .withColumns({"lo": F.least("b", "c"), "hi": F.greatest("b", "c")}))

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        left, right = pdf.sort_values("b").iloc[[0, -1]].itertuples(index=False)
        close, able, rows, cols = block_counts(np.asarray(left.ys, float), np.asarray(right.ys, float), left.eps if left.eps is not None else np.nan,
                                               (left.before, right.before), left.b == right.b, max_dim)
        head = [getattr(left, k) for k in keys]
        # a block against itself holds every partner of its rows
        if left.b == right.b:
            out = [(*head, int(left.b), close, able, rows)]
        else:
            out = [(*head, int(left.b), close, able, rows), (*head, int(right.b), [0] * max_dim, [0] * max_dim, cols)]
        return pd.DataFrame(out, columns=[*keys, "b", "close", "able", "deg"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in series.select(*keys).schema)
    got = dealt.groupBy(*keys, "lo", "hi").applyInPandas(count, f"{kinds}, b int, close array<long>, able array<long>, deg array<long>")

    def total(pdf: pd.DataFrame) -> pd.DataFrame:
        deg = np.sum(np.stack(pdf["deg"].to_numpy()), axis=0)
        row = [pdf[k].iloc[0] for k in keys] + [np.sum(np.stack(pdf[c].to_numpy()), axis=0) for c in ("close", "able")] + [int((deg * deg).sum())]
        return pd.DataFrame([row], columns=[*keys, "close", "able", "d2"])

    per_block = got.groupBy(*keys, "b").applyInPandas(total, f"{kinds}, close array<long>, able array<long>, d2 long")
    sums = per_block.groupBy(*keys).agg(F.sum("d2").alias("sum_d2"), F.sum(F.col("close")[0]).alias("p1"),
                                        *[F.sum(F.col(c)[m - 1]).alias(f"{a}_{m}") for m in range(2, max_dim + 1) for a, c in (("pm", "close"), ("p1", "able"))])
    st = blocks.groupBy(*keys).agg(F.first("n").alias("n"), F.first("eps").alias("eps")).join(sums, keys)
    n = F.col("n").cast("double")
    # NULL for series too short or without variation
    c1 = F.try_divide(F.col("p1"), n * (n - 1) / 2)
    sum_r = n + 2 * F.col("p1")
    sum_r2 = n + 4 * F.col("p1") + F.col("sum_d2")
    k = F.try_divide(sum_r2 - 3 * sum_r + 2 * n, n * (n - 1) * (n - 2))
    rows = []
    for m in range(2, max_dim + 1):
        npair = (n - m + 1) * (n - m) / 2
        cm_ = F.try_divide(F.col(f"pm_{m}"), npair)
        c1m = F.try_divide(F.col(f"p1_{m}"), npair)
        tmp = sum((k ** (m - j)) * (c1 ** (2 * j)) for j in range(1, m))
        var = 4 * (k ** m + 2 * tmp + ((m - 1) ** 2) * c1 ** (2 * m) - (m ** 2) * k * c1 ** (2 * m - 2))
        stat = F.when((var > 0) & (n > m), F.sqrt(n - m + 1) * (cm_ - c1m ** m) / F.sqrt(F.when(var > 0, var)))
        rows.append(F.struct(F.lit(m).alias("dim"), stat.alias("statistic")))
    out = st.select(*keys, "eps", F.inline(F.array(*rows)))
    return out.withColumn("p_value", F.expr(normal_two_sided_p_sql("statistic")))


def bds_residuals(preds: DataFrame, split: str = "test", max_dim: int = 3, keys=("symbol", "model")) -> DataFrame:
    res = residual_table(preds, split, keys).select(*keys, F.col("t").cast("long").alias("t"), F.col("e").alias("x"))
    return bds_test(res, list(keys), max_dim)
