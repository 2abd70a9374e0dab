"""BDS relational implementation vs a brute-force indicator-matrix computation."""
import math

import numpy as np
from pyspark.sql import functions as F

from ripplet.operators.bds import bds_test


def brute_bds(x, max_dim=3):
    x = np.asarray(x, float)
    n = len(x)
    eps = 0.5 * x.std()
    ind = (np.abs(x[:, None] - x[None, :]) < eps).astype(float)

    def csum(I, m):
        J = I
        for _ in range(m - 1):
            J = J[1:, 1:] * J[:-1, :-1]
        iu = np.triu_indices(len(J), 1)
        return J[iu].mean()

    c1 = csum(ind, 1)
    k = ((ind.sum(1) ** 2).sum() - 3 * ind.sum() + 2 * n) / (n * (n - 1) * (n - 2))
    out = []
    for m in range(2, max_dim + 1):
        tmp = sum(k ** (m - j) * c1 ** (2 * j) for j in range(1, m))
        var = 4 * (k ** m + 2 * tmp + (m - 1) ** 2 * c1 ** (2 * m) - m ** 2 * k * c1 ** (2 * m - 2))
        c1m = csum(ind[m - 1:, m - 1:], 1)
        cm = csum(ind, m)
        out.append(math.sqrt(n - m + 1) * (cm - c1m ** m) / math.sqrt(var))
    return out


def test_bds_matches_bruteforce(spark, bars):
    pdf = bars.where(F.col("symbol") == "A").orderBy("date").limit(300).toPandas()
    x = np.diff(np.log(pdf["close"].to_numpy()))  # a real series derived from the given tables
    df = spark.createDataFrame([("A", i, float(v)) for i, v in enumerate(x)], "symbol string, t long, x double")
    got = {r.dim: r.statistic for r in bds_test(df, ["symbol"]).collect()}
    ref = brute_bds(x)
    for m, v in zip((2, 3), ref):
        assert abs(got[m] - v) < 1e-9 * max(1.0, abs(v))
