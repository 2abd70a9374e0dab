"""Econometric forecasters (E1-E11) over the modelling panel.

Each forecaster returns the long prediction table
``(symbol, date, split, model, y_true, y_pred)`` aligned by key, where the
prediction at row t targets ``target_vol_t = vol_realized_{t+1}``.
All run for every symbol of the panel in one job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ripplet.functions.scan import affine_scans

KEYS = ["symbol", "date", "split"]


def _long(df: DataFrame, model: str, pred: Column, y: str = "target_vol") -> DataFrame:
    return df.select(*KEYS, F.lit(model).alias("model"), F.col(y).alias("y_true"),
                     pred.cast("double").alias("y_pred"))


def _sym():
    """Whole-series frame, same partitioning as the panel windows."""
    return Window.partitionBy("symbol")


def _ord():
    return Window.partitionBy("symbol").orderBy("date")


def naive_col() -> Column:
    """Persistence, pred = vol_realized_t."""
    return F.col("vol_realized")


def rolling_mean_col(window: int = 22) -> Column:
    """Mean of the last ``window`` vol_realized values (min_periods = 1)."""
    return F.avg("vol_realized").over(_ord().rowsBetween(-(window - 1), 0))


def ewma_scan(lam: float = 0.94, warm_up: int = 60, out: str = "_ewma_s2"):
    """E3 as an affine-scan spec (a, b, out) over the panel with ``_pos``.

    sigma2_0 = population variance of returns at positions 1..warm_up;
    sigma2_t = lam * sigma2_{t-1} + (1 - lam) * r_t^2 (missing r -> 0)."""
    r = F.coalesce(F.col("log_return"), F.lit(0.0))
    var0 = F.var_pop(F.when(F.col("_pos").between(1, warm_up), F.col("log_return"))).over(_sym())
    b = F.when(F.col("_pos") == 0, var0).otherwise(F.lit(1.0 - lam) * r * r)
    return (lam, b, out)


def garch_scan(alpha: float = 0.08, beta: float = 0.90, scale: float = 100.0,
               params: tuple[str, str, str] | None = None, out: str = "_garch_s2"):
    """E8 as an affine-scan spec: at row t, s_t = sigma2_{t+1} =
    omega + alpha * eps_t^2 + beta * sigma2_t with eps = scale * r (missing -> 0).

    Without ``params`` (column names of omega, alpha, beta) omega comes from
    variance targeting on the train rows: omega = v0 * (1 - alpha - beta) with
    v0 = mean(eps^2 | train), which is also sigma2_0."""
    eps = F.coalesce(F.col("log_return"), F.lit(0.0)) * F.lit(scale)
    v0 = F.avg(F.when(F.col("split") == "train", eps * eps)).over(_sym())
    if params is None:
        om, al, be = v0 * F.lit(1.0 - alpha - beta), F.lit(alpha), F.lit(beta)
    else:
        om, al, be = (F.col(c) for c in params)
    b = om + al * eps * eps
    b = F.when(F.col("_pos") == 0, b + be * v0).otherwise(b)
    return (be, b, out)


def har_col(components=("vol_d", "vol_w", "vol_m"), y: str = "target_vol") -> Column:
    """HAR-RV prediction from per-symbol OLS on train rows, clipped at 0.

    Sufficient statistics (means, population covariances over train rows
    with all regressors known) are whole-series window aggregates; the
    centred 3x3 system is solved by Cramer's rule as column expressions."""
    x = list(components)
    ok = (F.col("split") == "train") & F.col(y).isNotNull()
    for c in x:
        ok = ok & F.col(c).isNotNull()
    m = lambda c: F.when(ok, F.col(c))
    st = {"my": F.avg(m(y)).over(_sym())}
    for i, c in enumerate(x):
        st[f"m{i}"] = F.avg(m(c)).over(_sym())
        st[f"s{i}"] = F.covar_pop(m(c), m(y)).over(_sym())
        for j in range(i, 3):
            st[f"S{i}{j}"] = F.covar_pop(m(c), m(x[j])).over(_sym())
    return st


def add_forecasts(panel: DataFrame, lam: float = 0.94, alpha: float = 0.08, beta: float = 0.90,
                  scale: float = 100.0) -> DataFrame:
    """All SQL-exact forecasters as columns of the panel (one pass, one
    exchange on symbol for the windows plus one for the shared scans)."""
    df = panel.withColumn("_pos", F.row_number().over(_ord()) - 1)
    har = har_col()
    df = df.withColumns({f"_h_{k}": v for k, v in har.items()})
    df = affine_scans(df, ["symbol"], "date",
                      [ewma_scan(lam), garch_scan(alpha, beta, scale)])
    sol = har_solution_sql(prefix="_h_")
    pred = F.expr(sol["b0"])
    for i, c in enumerate(("vol_d", "vol_w", "vol_m")):
        pred = pred + F.expr(sol[f"b{i + 1}"]) * F.coalesce(F.col(c), F.col(f"_h_m{i}"))
    df = df.withColumns({
        "naive": naive_col(),
        "rolling_mean_22": rolling_mean_col(22),
        "ewma_094": F.sqrt("_ewma_s2"),
        "har_rv": clip0(pred),
        "garch_11": F.sqrt("_garch_s2") / F.lit(scale),
    })
    return df.drop("_pos", "_ewma_s2", "_garch_s2", *[f"_h_{k}" for k in har])


MODELS = ("naive", "rolling_mean_22", "ewma_094", "har_rv", "garch_11")


def to_long(wide: DataFrame, models=MODELS, y: str = "target_vol") -> DataFrame:
    """Wide forecast columns -> long (symbol, date, split, model, y_true, y_pred)."""
    base = wide.select(*KEYS, F.col(y).alias("y_true"), *[F.col(m).cast("double") for m in models])
    return (base.unpivot([*KEYS, "y_true"], list(models), "model", "y_pred")
                .select(*KEYS, "model", "y_true", "y_pred"))


def naive(panel: DataFrame) -> DataFrame:
    return _long(panel, "naive", naive_col())


def rolling_mean(panel: DataFrame, window: int = 22) -> DataFrame:
    return _long(panel, f"rolling_mean_{window}", rolling_mean_col(window))


def ewma(panel: DataFrame, lam: float = 0.94, warm_up: int = 60, strict: bool = False) -> DataFrame:
    """E3 alone; ``strict`` emits NULL for positions <= warm_up."""
    df = panel.withColumn("_pos", F.row_number().over(_ord()) - 1)
    df = affine_scans(df, ["symbol"], "date", [ewma_scan(lam, warm_up)])
    pred = F.sqrt("_ewma_s2")
    if strict:
        pred = F.when(F.col("_pos") > warm_up, pred)
    return _long(df, "ewma_094" if lam == 0.94 else f"ewma_{lam}", pred)


def garch_filter(panel: DataFrame, alpha: float = 0.08, beta: float = 0.90, scale: float = 100.0,
                 params: DataFrame | None = None, model: str = "garch_11") -> DataFrame:
    """E8 alone; ``params`` = (symbol, omega, alpha, beta) table from E7
    (one row per symbol)."""
    df = panel.withColumn("_pos", F.row_number().over(_ord()) - 1)
    cols = None
    if params is not None:
        df = df.join(params.select("symbol", F.col("omega").alias("_om"),
                                               F.col("alpha").alias("_al"), F.col("beta").alias("_be")),
                     "symbol")
        cols = ("_om", "_al", "_be")
    df = affine_scans(df, ["symbol"], "date", [garch_scan(alpha, beta, scale, cols)])
    return _long(df, model, F.sqrt("_garch_s2") / F.lit(scale))


def har_solution_sql(prefix: str = "") -> dict[str, str]:
    """Cramer's-rule solution of the centred 3x3 normal equations (SQL text)."""
    p = prefix
    S = {(i, j): f"{p}S{min(i, j)}{max(i, j)}" for i in range(3) for j in range(3)}
    s = [f"{p}s{i}" for i in range(3)]

    def det(m):
        return (f"(({m[0][0]})*(({m[1][1]})*({m[2][2]})-({m[1][2]})*({m[2][1]}))"
                f"-({m[0][1]})*(({m[1][0]})*({m[2][2]})-({m[1][2]})*({m[2][0]}))"
                f"+({m[0][2]})*(({m[1][0]})*({m[2][1]})-({m[1][1]})*({m[2][0]})))")

    M = [[S[(i, j)] for j in range(3)] for i in range(3)]
    d = det(M)
    out = {}
    for k in range(3):
        Mk = [[(s[i] if j == k else M[i][j]) for j in range(3)] for i in range(3)]
        out[f"b{k + 1}"] = f"({det(Mk)}) / NULLIF({d}, 0)"  # collinear components: no forecast
    out["b0"] = f"{p}my - (({out['b1']})*{p}m0 + ({out['b2']})*{p}m1 + ({out['b3']})*{p}m2)"
    return out


def har_rv(panel: DataFrame) -> DataFrame:
    return to_long(add_forecasts(panel), ["har_rv"])


def clip0(c: Column) -> Column:
    """max(pred, 0) keeping NULL."""
    return F.when(c.isNotNull(), F.greatest(c, F.lit(0.0)))


def summarize(preds: DataFrame, keys=("symbol", "split", "model")) -> DataFrame:
    """RMSE, MAE and number of valid pairs per (symbol, split, model)."""
    e = F.col("y_pred") - F.col("y_true")
    valid = F.col("y_pred").isNotNull() & F.col("y_true").isNotNull()
    return (preds.where(valid).groupBy(*keys)
                 .agg(F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
                      F.count(F.lit(1)).alias("n_valid")))


def cumulative_abs_error(preds: DataFrame) -> DataFrame:
    """Running sum of |error| (missing -> 0) per (symbol, split, model) by date."""
    w = (Window.partitionBy("symbol", "split", "model").orderBy("date")
         .rowsBetween(Window.unboundedPreceding, 0))
    e = F.coalesce(F.abs(F.col("y_pred") - F.col("y_true")), F.lit(0.0))
    return preds.select("symbol", "split", "model", "date", F.sum(e).over(w).alias("cum_abs_error"))


def all_benchmarks(panel: DataFrame) -> DataFrame:
    """The SQL-exact forecaster family in one long table."""
    return to_long(add_forecasts(panel))
