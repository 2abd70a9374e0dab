"""Packed order key preserves lexicographic order; bars are order-independent."""
import random

import pytest
from pyspark.sql import functions as F

from ripplet.sources.bars import packed_order_key


def test_packed_key_orders_like_tuples(spark):
    rng = random.Random(5)
    widths = [12, 1, 11, 10]
    rows = []
    for _ in range(400):
        base = (rng.randrange(10 ** 12), rng.randrange(8), rng.randrange(10 ** 11), rng.randrange(10 ** 10))
        rows.append(base)
        rows.append((base[0], base[1], base[2], min(base[3] + 1, 10 ** 10 - 1)))   # near-ties
        rows.append((base[0], base[1], min(base[2] + 1, 10 ** 11 - 1), 0))
    df = spark.createDataFrame(rows, "a long, b long, c long, d long")
    key = packed_order_key([F.col(c) for c in "abcd"], widths)
    got = [tuple(r[:4]) for r in df.select("a", "b", "c", "d", key.alias("k")).orderBy("k", "a", "b", "c", "d").collect()]
    assert got == sorted(rows)


def test_packed_key_rejects_out_of_range(spark):
    df = spark.createDataFrame([(10 ** 11, 1)], "a long, b long")
    with pytest.raises(Exception):
        df.select(packed_order_key([F.col("a"), F.col("b")], [11, 1]).alias("k")).collect()
