"""Per-series affine scans  s_t = a * s_{t-1} + b_t  (s_{-1} = 0).

Covers EWMA variance (a = lambda), GARCH filtering (a = beta) and the ARMA
innovation filter (a = -theta) without a Python loop.  Several scans over the
same series run together and share one exchange.

Two levels, both plain DataFrame operations:

1. rows are cut into blocks of B consecutive positions per series.  Inside a
   block, z_t = a^j * cumsum_{i<=t}(b_i * a^-j_i) with j the offset inside
   the block; B is chosen per series so that |a|^-B stays below e^600 for
   every scan (no overflow), so the in-block cumulative sum is a normal
   window sum.
2. the carry into block k is c_{k-1} = Z_{k-1} + a^B * c_{k-2} (Z = block-final
   z) and s_t = a^(j+1) * c_{k-1} + z_t.  Where B is below the maximum, |a|^B is
   about e^-600, so a^2B is zero in double precision and the carry is exactly
   Z_{k-1} + a^B * Z_{k-2}: two lagged values, linear in the rows.  Only scans
   with |a| so near 1 that B is the maximum (a million rows) fold their few
   block summaries, collected per series by a window.
   a = 0 is simply b.  No join back: the input plan is evaluated once.

All windows run in the partitioning of the series; one series is one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_LOG_LIMIT = 600.0
MAX_BLOCK = 1 << 20


def block_size(a: Column, max_block: int = MAX_BLOCK) -> Column:
    la = F.abs(F.ln(F.abs(a)))
    return (F.when((a == 0) | (F.abs(a) == 1), F.lit(max_block))
             .otherwise(F.greatest(F.lit(1), F.least(F.lit(max_block),
                                                      F.floor(F.lit(_LOG_LIMIT) / la)).cast("int"))))


def affine_scans(df: DataFrame, keys: list[str], order: str,
                 scans: list[tuple[Column | float, Column, str]],
                 max_block: int = MAX_BLOCK) -> DataFrame:
    """Append one column per scan ``(a, b, out)`` to every row of ``df``.

    ``a`` must be constant within a series (a literal or a per-series
    column); ``b`` may be any per-row expression (NULL is treated as 0)."""
    k = len(scans)
    w_pos = Window.partitionBy(*keys).orderBy(order)
    cols = {"_pos": F.row_number().over(w_pos) - 1}
    for i, (a, b, _) in enumerate(scans):
        a_col = F.lit(float(a)) if isinstance(a, (int, float)) else a
        cols[f"_sa{i}"] = a_col.cast("double")
        cols[f"_sb{i}"] = F.coalesce(b.cast("double"), F.lit(0.0))
    base = df.withColumns(cols)
    bsz = F.least(*[block_size(F.col(f"_sa{i}"), max_block) for i in range(k)]) if k > 1 \
        else block_size(F.col("_sa0"), max_block)
    base = base.withColumn("_bsz", bsz)
    base = base.withColumns({"_blk": F.floor(F.col("_pos") / F.col("_bsz")),
                             "_j": (F.col("_pos") - F.floor(F.col("_pos") / F.col("_bsz")) * F.col("_bsz"))
                             .cast("double")})
    w_blk = (Window.partitionBy(*keys, "_blk").orderBy("_pos")
             .rowsBetween(Window.unboundedPreceding, 0))
    base = base.withColumns({
        f"_sz{i}": F.when(F.col(f"_sa{i}") == 0, F.col(f"_sb{i}")).otherwise(
            F.pow(F.col(f"_sa{i}"), F.col("_j"))
            * F.sum(F.col(f"_sb{i}") * F.pow(F.col(f"_sa{i}"), -F.col("_j"))).over(w_blk))
        for i in range(k)})
    # Block-final values of the two blocks before, spread over the block's rows.
    w_head = Window.partitionBy(*keys, "_blk").orderBy("_pos")
    for step, src in (("_sp", "_sz"), ("_sq", "_sp")):
        base = base.withColumns({f"{step}l{i}": F.lag(f"{src}{i}", 1).over(w_pos) for i in range(k)})
        base = base.withColumns({f"{step}{i}": F.first(f"{step}l{i}").over(w_head) for i in range(k)})

    # For |a| near 1: the last row of each (million-row) block carries
    # (blk, a^len, Z) and a whole-series window collects them.  No join back and
    # no extra exchange: (keys) hash partitioning satisfies the (keys, _blk) windows.
    last = F.col("_pos") == F.max("_pos").over(Window.partitionBy(*keys, "_blk"))
    summ = F.struct(F.col("_blk").cast("bigint").alias("blk"),
                    *[F.pow(F.col(f"_sa{i}"), F.col("_j") + 1).alias(f"A{i}") for i in range(k)],
                    *[F.col(f"_sz{i}").alias(f"Z{i}") for i in range(k)])
    whole = F.col("_bsz") >= F.lit(max_block)
    base = base.withColumn("_bl", F.array_sort(F.collect_list(F.when(last & whole, summ)).over(Window.partitionBy(*keys))))
    zero = ", ".join(f"'c{i}', CAST(0.0 AS DOUBLE)" for i in range(k))
    nxt = ", ".join(f"'c{i}', x.A{i} * acc.c{i} + x.Z{i}" for i in range(k))
    carry = F.expr(f"aggregate(filter(_bl, x -> x.blk < _blk), named_struct({zero}), "
                   f"(acc, x) -> named_struct({nxt}))")
    base = base.withColumn("_cin", F.when((F.col("_blk") > 0) & whole, carry))
    zero_ = F.lit(0.0)
    carried = [F.when(whole, F.coalesce(F.col(f"_cin.c{i}"), zero_)).otherwise(
        F.coalesce(F.col(f"_sp{i}"), zero_) + F.pow(F.col(f"_sa{i}"), F.col("_bsz").cast("double")) * F.coalesce(F.col(f"_sq{i}"), zero_))
        for i in range(k)]
    outs = {out: F.pow(F.col(f"_sa{i}"), F.col("_j") + 1) * carried[i] + F.col(f"_sz{i}") for i, (_, _, out) in enumerate(scans)}
    drop = ["_pos", "_bsz", "_blk", "_j", "_bl", "_cin"] + [f"_s{x}{i}" for i in range(k) for x in ("a", "b", "z", "p", "pl", "q", "ql")]
    return base.withColumns(outs).drop(*drop)


def affine_scan(df: DataFrame, keys: list[str], order: str, a: Column | float, b: Column,
                out: str = "state", max_block: int = MAX_BLOCK) -> DataFrame:
    """Single-scan convenience wrapper of :func:`affine_scans`."""
    return affine_scans(df, keys, order, [(a, b, out)], max_block)
