"""ARMA(1,1) and GARCH(1,1) without a single-machine optimiser.

E4  ARMA(1,1) by Hannan-Rissanen per symbol on train vol_realized:
    (1) long AR(m) by OLS -> innovations e^;  (2) OLS of y_t on
    [1, y_{t-1}, e^_{t-1}] -> (c, phi, theta).  Both are one aggregation of
    normal equations per symbol (X3).  ``arma11_mle`` goes on from there to the
    exact likelihood, by scans over candidate grids.
E5  innovation filter e_t = y_t - c - phi*y_{t-1} - theta*e_{t-1}: an affine
    scan with a = -theta over the whole series (train, val and test, no gap);
    forecast for t+1 made at t: c + phi*y_t + theta*e_t, clipped at 0.
    ``align="reference"`` reproduces the one-step-stale alignment (T3).
E7  GARCH(1,1) on 100 x train returns, zero mean, normal likelihood, with
    variance targeting omega = s2 * (1 - alpha - beta): an (alpha, beta) grid is
    exploded per row (grid size is a parameter), every candidate's variance
    path is one affine scan keyed by (symbol, candidate), the log-likelihood
    is an aggregation and the best candidate is ``max_by``; a finer grid
    around the winner refines it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ripplet.functions.linalg import gram, solve
from ripplet.functions.scan import affine_scans
from ripplet.operators.forecast import KEYS, _long
from ripplet.session import materialize

LOG_2PI = 1.8378770664093453


def _ord():
    return Window.partitionBy("symbol").orderBy("date")


def arma11_fit(panel: DataFrame, y: str = "vol_realized", ar_order: int = 10) -> DataFrame:
    """(symbol, c, phi, theta) by Hannan-Rissanen on train rows."""
    tr = panel.where(F.col("split") == "train").select("symbol", "date", F.col(y).alias("_y"))
    w = _ord()
    lags = {f"_y{k}": F.lag("_y", k).over(w) for k in range(1, ar_order + 1)}
    tr = tr.withColumns(lags)
    xs = [F.lit(1.0)] + [F.col(f"_y{k}") for k in range(1, ar_order + 1)]
    ar = solve(gram(tr, ["symbol"], xs, F.col("_y")), ["symbol"])
    tr = tr.join(ar, "symbol")  # one row per symbol
    fitted = F.col("coef")[0]
    for k in range(1, ar_order + 1):
        fitted = fitted + F.col("coef")[k] * F.col(f"_y{k}")
    tr = tr.withColumn("_e", F.col("_y") - fitted)
    tr = tr.withColumn("_e1", F.lag("_e", 1).over(w))
    st2 = solve(gram(tr, ["symbol"], [F.lit(1.0), F.col("_y1"), F.col("_e1")], F.col("_y")), ["symbol"])
    # An innovation filter with |theta| >= 1 diverges; its mirror image 1 / theta has the same autocorrelations.
    theta = F.col("coef")[2]
    inside = (F.when(F.abs(theta) > 1, F.try_divide(F.lit(1.0), theta)).when(F.abs(theta) == 1, theta * F.lit(1 - 1e-6)).otherwise(theta))
    return st2.select("symbol", F.col("coef")[0].alias("c"), F.col("coef")[1].alias("phi"), inside.alias("theta"))


def arma11_loglik(train: DataFrame, cands: DataFrame) -> DataFrame:
    """Exact Gaussian log-likelihood of ARMA(1,1) candidates, mean and variance concentrated out: (symbol, cand, phi, theta,
    mu, sigma2, loglik).  ``train``: (symbol, date, _y, _pos) without gaps; ``cands``: (symbol, cand, phi, theta), a bounded list a symbol.

    The one-step variance ratio r_t of the innovations algorithm is p_{t+1} / p_t with p_t = A + B theta^{2t}, so p_t u_t (u_t
    the innovation) is an affine scan with the constant factor -theta.  u_t is linear in the mean: one scan of y, one
    of the constant 1, and sums of their products give the best mean, the variance and the likelihood."""
    w = Window.partitionBy("symbol", "cand").orderBy("date")
    d = train.join(cands, "symbol")
    phi, theta, t = F.col("phi"), F.col("theta"), F.col("_pos").cast("double")
    th2 = theta * theta
    r0 = 1.0 + (phi + theta) * (phi + theta) / (1.0 - phi * phi)
    b = (r0 - 1.0) / (th2 - 1.0)
    p = lambda k: (1.0 - b) + b * F.pow(th2, t + F.lit(float(k)))
    d = d.withColumns({"_p": p(0), "_r": p(1) / p(0), "_y1": F.lag("_y", 1).over(w)})
    first = F.col("_pos") == 0
    d = affine_scans(d, ["symbol", "cand"], "date", [
        (-theta, F.when(first, F.col("_y")).otherwise(F.col("_p") * (F.col("_y") - phi * F.col("_y1"))), "_wy"),
        (-theta, F.when(first, F.lit(1.0)).otherwise(F.col("_p") * (1.0 - phi)), "_w1")])
    uy, u1, r = F.col("_wy") / F.col("_p"), F.col("_w1") / F.col("_p"), F.col("_r")
    s = d.groupBy("symbol", "cand", "phi", "theta").agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum(uy * uy / r).alias("yy"),
                                                        F.sum(uy * u1 / r).alias("y1"), F.sum(u1 * u1 / r).alias("oo"), F.sum(F.ln(r)).alias("lr"))
    s2 = (F.col("yy") - F.col("y1") * F.col("y1") / F.col("oo")) / F.col("n")
    s = s.withColumns({"mu": F.col("y1") / F.col("oo"), "sigma2": s2})
    ll = -0.5 * F.col("n") * (F.lit(LOG_2PI) + F.ln("sigma2") + 1.0) - 0.5 * F.col("lr")
    return s.withColumn("loglik", F.when(F.col("sigma2") > 0, ll)).select("symbol", "cand", "phi", "theta", "mu", "sigma2", "loglik")


def arma11_mle(panel: DataFrame, y: str = "vol_realized", coarse: int = 9, fine: int = 5, rounds: int = 5, edge: float = 0.995) -> DataFrame:
    """E4 by likelihood: (symbol, c, phi, theta, sigma2, loglik, loglik_start).  The Hannan-Rissanen estimate and a coarse (phi, theta)
    grid start; each round then tries a finer grid around the best so far (X2), every symbol in one job."""
    tr = panel.where((F.col("split") == "train") & F.col(y).isNotNull()).select("symbol", "date", F.col(y).cast("double").alias("_y"))
    tr = materialize(tr.withColumn("_pos", F.row_number().over(_ord()) - 1), "arma-train")
    axis = [-edge + 2 * edge * (i + 0.5) / coarse for i in range(coarse)]
    grid = F.array(*[F.struct(F.lit(a).alias("phi"), F.lit(b).alias("theta")) for a in axis for b in axis])
    clip = lambda c: F.greatest(F.least(c, F.lit(edge)), F.lit(-edge))
    start = arma11_fit(panel, y).select("symbol", F.lit(-1).alias("cand"), clip(F.col("phi")).alias("phi"), clip(F.col("theta")).alias("theta"))
    cands = start.where("phi IS NOT NULL AND theta IS NOT NULL").unionByName(
        tr.select("symbol").distinct().select("symbol", F.posexplode(grid).alias("cand", "g")).select("symbol", "cand", "g.phi", "g.theta"))
    best, step = None, 2 * edge / coarse
    for k in range(rounds + 1):
        ll = arma11_loglik(tr, cands)
        win = ll.groupBy("symbol").agg(F.max_by(F.struct("phi", "theta", "mu", "sigma2", "loglik"), F.struct(F.coalesce("loglik", F.lit(float("-inf"))), -F.col("cand"))).alias("w"),
                                       F.max(F.when(F.col("cand") == -1, F.col("loglik"))).alias("loglik_start"))
        if best is not None:  # the centre of a round's grid is the best so far, so a round never loses
            win = win.drop("loglik_start").join(best.select("symbol", "loglik_start"), "symbol")
        best = materialize(win, "arma-best")
        if k < rounds:
            offsets = [step * (2 * i / (fine - 1) - 1) for i in range(fine)]
            around = F.array(*[F.struct(clip(F.col("w.phi") + F.lit(a)).alias("phi"), clip(F.col("w.theta") + F.lit(b)).alias("theta")) for a in offsets for b in offsets])
            cands = best.select("symbol", F.posexplode(around).alias("cand", "g")).select("symbol", "cand", "g.phi", "g.theta")
            step *= 2 / (fine - 1)
    return best.select("symbol", (F.col("w.mu") * (1.0 - F.col("w.phi"))).alias("c"), "w.phi", "w.theta", "w.sigma2", "w.loglik", "loglik_start")


def arma11_forecast(panel: DataFrame, params: DataFrame | None = None, y: str = "vol_realized",
                    align: str = "correct", model: str = "arima_101") -> DataFrame:
    """E5: filtered one-step forecasts for every row, long form."""
    params = params if params is not None else arma11_fit(panel, y)
    w = _ord()
    df = panel.join(params, "symbol").withColumn("_y1", F.lag(y, 1).over(w))
    b = F.col(y) - F.col("c") - F.col("phi") * F.coalesce(F.col("_y1"), F.col(y))
    df = affine_scans(df, ["symbol"], "date", [(-F.col("theta"), b, "_e")])
    nxt = F.col("c") + F.col("phi") * F.col(y) + F.col("theta") * F.col("_e")
    if align == "reference":
        nxt = F.lag(nxt, 1).over(w)
    return _long(df, model, F.when(nxt.isNotNull(), F.greatest(nxt, F.lit(0.0))))


def _grid(alphas, betas):
    return [(float(a), float(b)) for a in alphas for b in betas if a + b < 0.9999]


def _loglik(tr: DataFrame, cands: list[tuple[float, float]], scale: float) -> DataFrame:
    arr = F.array(*[F.struct(F.lit(i).alias("cand"), F.lit(a).alias("alpha"), F.lit(b).alias("beta"))
                    for i, (a, b) in enumerate(cands)])
    d = tr.select("symbol", "date", "_eps2", "_s2bar", "_pos", F.explode(arr).alias("p")) \
          .select("symbol", "date", "_eps2", "_s2bar", "_pos", "p.*")
    omega = F.col("_s2bar") * (1.0 - F.col("alpha") - F.col("beta"))
    prev_eps2 = F.lag("_eps2", 1).over(Window.partitionBy("symbol", "cand").orderBy("date"))
    b = F.when(F.col("_pos") == 0, F.col("_s2bar")).otherwise(omega + F.col("alpha") * prev_eps2)
    d = affine_scans(d, ["symbol", "cand"], "date", [(F.col("beta"), b, "_s2")])
    ll = -0.5 * (F.lit(LOG_2PI) + F.ln("_s2") + F.col("_eps2") / F.col("_s2"))
    return d.groupBy("symbol", "cand", "alpha", "beta").agg(F.sum(ll).alias("loglik"),
                                                            F.first("_s2bar").alias("s2bar"))


def garch11_fit(panel: DataFrame, scale: float = 100.0, coarse: int = 12, fine: int = 7) -> DataFrame:
    """(symbol, omega, alpha, beta, loglik) on scaled train returns."""
    tr = panel.where(F.col("split") == "train").where(F.col("log_return").isNotNull()) \
              .select("symbol", "date", ((F.col("log_return") * scale) ** 2).alias("_eps2"))
    w = _ord()
    tr = tr.withColumns({"_pos": F.row_number().over(w) - 1,
                         "_s2bar": F.avg("_eps2").over(Window.partitionBy("symbol"))})
    alphas = [0.01 + i * (0.30 - 0.01) / (coarse - 1) for i in range(coarse)]
    betas = [0.0 + i * (0.98 - 0.0) / (coarse - 1) for i in range(coarse)]
    ll = _loglik(tr, _grid(alphas, betas), scale)
    best = ll.groupBy("symbol").agg(F.max_by(F.struct("alpha", "beta"), "loglik").alias("b"))
    # Refinement: a local grid around each symbol's winner (one job for all symbols).
    da, db = (0.29 / (coarse - 1)), (0.98 / (coarse - 1))
    offs = [(-1 + 2 * i / (fine - 1)) for i in range(fine)]
    rows = best.select("symbol", "b.alpha", "b.beta")
    ref = rows.select("symbol", F.explode(F.array(*[
        F.struct((F.col("alpha") + F.lit(oa * da)).alias("alpha"), (F.col("beta") + F.lit(ob * db)).alias("beta"))
        for oa in offs for ob in offs])).alias("p")).select("symbol", "p.*") \
        .where((F.col("alpha") > 0) & (F.col("beta") > 0) & (F.col("alpha") + F.col("beta") < 0.9999))
    ref = ref.withColumn("cand", F.row_number().over(Window.partitionBy("symbol").orderBy("alpha", "beta")))
    d = tr.join(ref, "symbol")  # per-symbol candidate list, bounded by fine^2
    omega = F.col("_s2bar") * (1.0 - F.col("alpha") - F.col("beta"))
    prev_eps2 = F.lag("_eps2", 1).over(Window.partitionBy("symbol", "cand").orderBy("date"))
    b = F.when(F.col("_pos") == 0, F.col("_s2bar")).otherwise(omega + F.col("alpha") * prev_eps2)
    d = affine_scans(d, ["symbol", "cand"], "date", [(F.col("beta"), b, "_s2")])
    llf = -0.5 * (F.lit(LOG_2PI) + F.ln("_s2") + F.col("_eps2") / F.col("_s2"))
    fin = d.groupBy("symbol", "cand", "alpha", "beta").agg(F.sum(llf).alias("loglik"),
                                                           F.first("_s2bar").alias("s2bar"))
    allc = fin.unionByName(ll)
    win = allc.groupBy("symbol").agg(F.max_by(F.struct("alpha", "beta", "loglik", "s2bar"), "loglik").alias("w"))
    return win.select("symbol", (F.col("w.s2bar") * (1 - F.col("w.alpha") - F.col("w.beta"))).alias("omega"),
                      F.col("w.alpha").alias("alpha"), F.col("w.beta").alias("beta"),
                      F.col("w.loglik").alias("loglik"))


def _upto(lo, hi):
    """[lo, lo+1, ..., hi], empty when lo > hi (``sequence`` would count down)."""
    return F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<int>"))


def arma11_refit_forecast(panel: DataFrame, refit_every: int = 250, y: str = "vol_realized",
                          ar_order: int = 10, model: str = "arima_101_refit") -> DataFrame:
    """Periodic re-estimation.  Rows after the end of train are cut into
    epochs of ``refit_every`` rows; epoch e is forecast with parameters fitted
    (Hannan-Rissanen) on every row before the epoch starts, and — as a refit
    re-filters the whole history — its innovation filter runs from the first
    row with those parameters.  Rows are replicated once per later epoch
    (O(n * epochs) rows), never per row pair."""
    w = _ord()
    n_tr = F.count_if(F.col("split") == "train").over(Window.partitionBy("symbol"))
    df = panel.withColumns({"_pos": F.row_number().over(w) - 1, "_ntr": n_tr,
                            "_y1": F.lag(y, 1).over(w)})
    df = df.withColumns({f"_y{k}": F.lag(y, k).over(w) for k in range(2, ar_order + 1)})
    df = df.withColumn("_ep", F.when(F.col("_pos") < F.col("_ntr"), F.lit(-1))
                       .otherwise(F.floor((F.col("_pos") - F.col("_ntr")) / F.lit(refit_every))).cast("int"))
    n_ep = F.max("_ep").over(Window.partitionBy("symbol")) + 1
    df = df.withColumn("_nep", n_ep)
    # Fit sets: a row belongs to the fit of every epoch that starts after it.
    fit = df.withColumn("epoch", F.explode(_upto(F.greatest(F.col("_ep") + 1, F.lit(0)), F.col("_nep") - 1)))
    keys = ["symbol", "epoch"]
    xs = [F.lit(1.0)] + [F.col(f"_y{k}") for k in range(1, ar_order + 1)]
    ar = solve(gram(fit.withColumn("_yy", F.col(y)), keys, xs, F.col("_yy")), keys)
    f2 = fit.join(ar, keys)  # one row per (symbol, epoch)
    fitted = F.col("coef")[0]
    for k in range(1, ar_order + 1):
        fitted = fitted + F.col("coef")[k] * F.col(f"_y{k}")
    f2 = f2.withColumn("_e", F.col(y) - fitted)
    f2 = f2.withColumn("_e1", F.lag("_e", 1).over(Window.partitionBy(*keys).orderBy("date")))
    st2 = solve(gram(f2, keys, [F.lit(1.0), F.col("_y1"), F.col("_e1")], F.col(y)), keys) \
        .select(*keys, F.col("coef")[0].alias("c"), F.col("coef")[1].alias("phi"), F.col("coef")[2].alias("theta"))
    # Filter sets: epoch e re-filters every row up to its own end.
    filt = df.withColumn("epoch", F.explode(_upto(F.greatest(F.col("_ep"), F.lit(0)),
                                                  F.greatest(F.col("_nep") - 1, F.lit(0)))))
    filt = filt.join(st2, keys)
    b = F.col(y) - F.col("c") - F.col("phi") * F.coalesce(F.col("_y1"), F.col(y))
    filt = affine_scans(filt, keys, "date", [(-F.col("theta"), b, "_inn")])
    nxt = F.col("c") + F.col("phi") * F.col(y) + F.col("theta") * F.col("_inn")
    # Train rows take epoch 0 (the train-only fit); later rows their own epoch.
    own = filt.where((F.col("epoch") == F.greatest(F.col("_ep"), F.lit(0))))
    return _long(own, model, F.when(nxt.isNotNull(), F.greatest(nxt, F.lit(0.0))))
