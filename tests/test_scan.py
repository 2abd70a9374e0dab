"""X1 affine scan equals the sequential recursion (several blocks, signs, edge a)."""
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ripplet.functions.scan import affine_scans


def sequential(a, b):
    s, out = 0.0, []
    for x in b:
        s = a * s + x
        out.append(s)
    return np.array(out)


@pytest.mark.parametrize("a", [0.94, 0.5, -0.7, 0.0, 1.0, 1e-3])
@pytest.mark.parametrize("max_block", [7, 1 << 20])
def test_scan_matches_loop(spark, a, max_block):
    rng = np.random.default_rng(7)
    rows = []
    for sym, n in (("A", 53), ("B", 1), ("C", 20)):
        for t, x in enumerate(rng.normal(size=n)):
            rows.append((sym, t, float(x)))
    pdf = pd.DataFrame(rows, columns=["symbol", "t", "b"])
    df = spark.createDataFrame(pdf)
    out = affine_scans(df, ["symbol"], "t", [(a, F.col("b"), "s"), (0.9, F.col("b") * 2, "s2")],
                       max_block=max_block).toPandas().sort_values(["symbol", "t"])
    for sym, g in pdf.groupby("symbol"):
        got = out[out.symbol == sym]
        np.testing.assert_allclose(got["s"].to_numpy(), sequential(a, g["b"].to_numpy()), rtol=1e-9, atol=1e-12)
        np.testing.assert_allclose(got["s2"].to_numpy(), sequential(0.9, 2 * g["b"].to_numpy()),
                                   rtol=1e-9, atol=1e-12)
