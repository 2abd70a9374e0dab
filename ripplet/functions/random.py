"""Deterministic, partition-independent pseudo-randomness.

``rand()`` depends on partitioning; here every draw is a pure hash of its keys
(seed, replicate, position...).  The keys are joined with a separator and hashed
as one text, so no linear relation between keys survives (draw (b + 1, pos) is
not draw (b, pos + c) for any c), and 60 bits of the MD5 are used, so more rows
than any table holds can be drawn.  MD5 exists in both SQL dialects: the DuckDB
oracle draws the very same numbers.
"""

from __future__ import annotations

BITS = 60


def hash60_sql(k0: str, k1: str, k2: str, dialect: str = "spark") -> str:
    """Uniform integer in [0, 2^60) from three integer key expressions."""
    cast = "STRING" if dialect == "spark" else "VARCHAR"
    keys = ", ".join(f"CAST(CAST({k} AS BIGINT) AS {cast})" for k in (k0, k1, k2))
    digits = f"substr(md5(concat_ws('|', {keys})), 1, {BITS // 4})"
    return f"CAST(conv({digits}, 16, 10) AS BIGINT)" if dialect == "spark" else f"CAST(('0x' || {digits}) AS BIGINT)"


def uniform_sql(k0: str, k1: str, k2: str, dialect: str = "spark") -> str:
    """U[0, 1) from the hash's top 52 bits (exact in a double)."""
    div = "DIV" if dialect == "spark" else "//"
    return f"(CAST(({hash60_sql(k0, k1, k2, dialect)} {div} {1 << (BITS - 52)}) AS DOUBLE) / CAST({1 << 52} AS DOUBLE))"


def index_sql(k0: str, k1: str, k2: str, n: str, dialect: str = "spark") -> str:
    """Uniform index in [0, n)."""
    return f"({hash60_sql(k0, k1, k2, dialect)} % CAST({n} AS BIGINT))"


BUCKET_ROWS = 100_000


def dense_buckets(n: int) -> int:
    """Number of buckets of ``dense_index`` for ``n`` rows: it grows with the data."""
    return max(1, -(-n // BUCKET_ROWS))


def dense_index(df, id_col: str, n: int):
    """Dense 0..n-1 index in the order (hash bucket, id) without a global sort:
    per-bucket counts -> prefix offsets (one row per bucket) -> offset +
    row_number inside the bucket.  The bucket hash is portable (X4)."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    b = df.withColumn("_bk", F.expr(index_sql("0", id_col, "0", str(dense_buckets(n)))))
    off = (b.groupBy("_bk").agg(F.count(F.lit(1)).alias("_c"))
            .withColumn("_off", F.sum("_c").over(Window.orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)))
            .select("_bk", F.coalesce("_off", F.lit(0)).alias("_off")))
    w = Window.partitionBy("_bk").orderBy(id_col)
    return b.join(off, "_bk").withColumn("_i", F.col("_off") + F.row_number().over(w) - 1).drop("_bk", "_off")
