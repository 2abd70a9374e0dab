"""DuckDB oracle SQL (independent re-statement of each query in SQL).

The driver runs these against views of the same parquet tables.  Helpers
below generate repetitive SQL text (window lists, lag expansions); the
statements themselves are plain SQL."""

from __future__ import annotations

from ripplet.functions.expr import sql_rnd

# Rounding digits per output column family (hash-stable compare).
# Exact picks (prices have at most 7 decimals) keep the default 8 digits, which
# never lands on a decimal tie; float sums of prices (~1e4) round to 4 digits so
# ulp-level summation-order differences cannot cross a rounding boundary.
SUM_PRICE_COLS = ("sma_10", "sma_22", "sma_50")
DIGITS = {**{c: 4 for c in SUM_PRICE_COLS}, "skew_22": 6, "kurt_22": 6}

W = "PARTITION BY symbol ORDER BY date"


def _frame(n: int) -> str:
    return f"({W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def _g(agg: str, x: str, n: int) -> str:
    return f"CASE WHEN count({x}) OVER {_frame(n)} = {n} THEN {agg}({x}) OVER {_frame(n)} END"


def daily_bars_sql() -> str:
    return """
    SELECT symbol, date,
           arg_min(price, row(l_orderkey, l_linenumber, l_partkey, l_suppkey, price)) AS open,
           max(price) AS high, min(price) AS low,
           arg_max(price, row(l_orderkey, l_linenumber, l_partkey, l_suppkey, price)) AS close,
           sum(l_quantity) AS volume
    FROM (SELECT CAST(l_returnflag AS VARCHAR) AS symbol, CAST(l_shipdate AS DATE) AS date,
                 l_extendedprice / l_quantity AS price, l_quantity,
                 l_orderkey, l_linenumber, l_partkey, l_suppkey
          FROM lineitem WHERE l_quantity > 0) t
    GROUP BY symbol, date"""


def hourly_bars_sql() -> str:
    return """
    SELECT event_type AS symbol, date_trunc('hour', ts) AS date,
           arg_min(value, row(ts, event_id, value)) AS open,
           max(value) AS high, min(value) AS low,
           arg_max(value, row(ts, event_id, value)) AS close,
           CAST(count(*) AS DOUBLE) AS volume
    FROM events GROUP BY event_type, date_trunc('hour', ts)"""


FEATURES = (
    [f"ret_lag_{k}" for k in (1, 2, 3, 5, 10)]
    + [f"vol_{w}" for w in (5, 10, 22)]
    + ["vol_d", "vol_w", "vol_m"]
    + [f"momentum_{w}" for w in (5, 10, 22)]
    + ["range_hl", "true_range", "atr_14"]
    + ["log_volume", "volume_lag_1", "log_volume_ma_10", "volume_ratio"]
    + [f"sma_{w}" for w in (10, 22, 50)]
    + [f"px_dist_sma_{w}" for w in (10, 22, 50)]
    + ["skew_22", "kurt_22", "dow", "month"]
)


def panel_ctes(bars_sql: str) -> str:
    """CTE chain: bars -> returns -> features -> targets -> clean -> split.
    Ends with a CTE named ``panel``."""
    lags = ",\n".join(f"lag(log_return, {k}) OVER ({W}) AS l{k}" for k in range(22))
    mean = "(" + " + ".join(f"l{k}" for k in range(22)) + ") / 22.0"
    cm = {p: "(" + " + ".join(f"power(l{k} - mu, {p})" for k in range(22)) + ") / 22.0" for p in (2, 3, 4)}
    allnn = " AND ".join(f"l{k} IS NOT NULL" for k in range(22))
    n = 22
    g1 = f"(m3 / power(m2, 1.5)) * {((n * (n - 1)) ** 0.5) / (n - 2)!r}"
    g2 = f"((m4 / (m2 * m2) - 3.0) * {float(n + 1)!r} + 6.0) * {(n - 1) / ((n - 2) * (n - 3))!r}"
    feats_first = ",\n".join([
        *[f"lag(log_return, {k}) OVER ({W}) AS ret_lag_{k}" for k in (1, 2, 3, 5, 10)],
        *[f"{_g('stddev_samp', 'log_return', w)} AS vol_{w}" for w in (5, 10, 22)],
        f"lag(vol_realized, 1) OVER ({W}) AS vol_d",
        f"CASE WHEN count(vol_realized) OVER ({W} ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) = 5 "
        f"THEN avg(vol_realized) OVER ({W} ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) END AS vol_w",
        f"CASE WHEN count(vol_realized) OVER ({W} ROWS BETWEEN 22 PRECEDING AND 1 PRECEDING) = 22 "
        f"THEN avg(vol_realized) OVER ({W} ROWS BETWEEN 22 PRECEDING AND 1 PRECEDING) END AS vol_m",
        *[f"{_g('sum', 'log_return', w)} AS momentum_{w}" for w in (5, 10, 22)],
        "(high - low) / NULLIF(close, 0) AS range_hl",
        f"CASE WHEN lag(close) OVER ({W}) IS NOT NULL AND high IS NOT NULL AND low IS NOT NULL THEN "
        f"greatest(high - low, abs(high - lag(close) OVER ({W})), abs(low - lag(close) OVER ({W}))) "
        f"/ NULLIF(close, 0) END AS true_range",
        "CASE WHEN volume > 0 THEN ln(volume) END AS log_volume",
        f"lag(volume, 1) OVER ({W}) AS volume_lag_1",
        f"volume / NULLIF({_g('avg', 'volume', 20)}, 0) AS volume_ratio",
        *[f"{_g('avg', 'close', w)} AS sma_{w}" for w in (10, 22, 50)],
        "CAST(isodow(date) - 1 AS INTEGER) AS dow",
        "CAST(month(date) AS INTEGER) AS month",
    ])
    clean_pred = " AND ".join(f"{c} IS NOT NULL" for c in FEATURES + ["target_vol", "target_regime"])
    return f"""
    bars AS ({bars_sql}),
    r1 AS (SELECT *, CASE WHEN close > 0 AND lag(close) OVER ({W}) > 0
                          THEN ln(close / lag(close) OVER ({W})) END AS log_return FROM bars),
    r2 AS (SELECT *, {_g('stddev_samp', 'log_return', 5)} AS vol_realized FROM r1),
    f1 AS (SELECT *, {feats_first} FROM r2),
    f2 AS (SELECT *,
             {_g('avg', 'true_range', 14)} AS atr_14,
             {_g('avg', 'log_volume', 10)} AS log_volume_ma_10,
             {", ".join(f"(close - sma_{w}) / NULLIF(sma_{w}, 0) AS px_dist_sma_{w}" for w in (10, 22, 50))}
           FROM f1),
    mo AS (SELECT symbol, date, {lags} FROM r2),
    mo2 AS (SELECT *, CASE WHEN {allnn} THEN {mean} END AS mu FROM mo),
    mo3 AS (SELECT symbol, date, {cm[2]} AS m2, {cm[3]} AS m3, {cm[4]} AS m4 FROM mo2),
    mo4 AS (SELECT symbol, date,
                   CASE WHEN m2 > 0 THEN {g1} END AS skew_22,
                   CASE WHEN m2 > 0 THEN {g2} END AS kurt_22 FROM mo3),
    feat AS (SELECT f2.*, mo4.skew_22, mo4.kurt_22 FROM f2 JOIN mo4 USING (symbol, date)),
    t1 AS (SELECT *, lead(vol_realized, 1) OVER ({W}) AS target_vol,
                  row_number() OVER ({W}) AS _rn,
                  count(*) OVER (PARTITION BY symbol) AS _n FROM feat),
    thr AS (SELECT symbol, quantile_cont(target_vol, 0.5) AS regime_threshold
            FROM t1 WHERE _rn <= floor(_n * CAST(0.7 AS DOUBLE)) AND target_vol IS NOT NULL
            GROUP BY symbol),
    t2 AS (SELECT t1.* EXCLUDE (_rn, _n), thr.regime_threshold,
                  CASE WHEN target_vol IS NOT NULL THEN CAST(target_vol > thr.regime_threshold AS INTEGER) END
                    AS target_regime
           FROM t1 LEFT JOIN thr USING (symbol)),
    cl AS (SELECT *, row_number() OVER ({W}) AS _rn, count(*) OVER (PARTITION BY symbol) AS _n
           FROM t2 WHERE {clean_pred}),
    panel AS (SELECT * EXCLUDE (_rn, _n),
                CASE WHEN _rn <= floor(_n * CAST(0.7 AS DOUBLE)) THEN 'train'
                     WHEN _rn <= floor(_n * CAST(0.7 AS DOUBLE)) + floor(_n * CAST(0.15 AS DOUBLE)) THEN 'val'
                     ELSE 'test' END AS split
              FROM cl)"""


def select_rounded(cols: list[tuple[str, str]], digits: dict[str, int] | None = None, default: int = 8) -> str:
    """cols: (name, kind) with kind 'd' (double, rounded) or 'k' (kept as is)."""
    digits = digits or {}
    out = []
    for name, kind in cols:
        if kind == "d":
            out.append(f"{sql_rnd(name, digits.get(name, default))} AS {name}")
        else:
            out.append(name)
    return ", ".join(out)


def preds_ctes(lam: float = 0.94, alpha: float = 0.08, beta: float = 0.90, scale: float = 100.0) -> str:
    """Forecaster CTEs after ``panel``; ends with ``preds`` (long form).
    EWMA and GARCH use recursive CTEs (the sequential definition)."""
    from ripplet.operators.forecast import har_solution_sql
    har = har_solution_sql()
    one_m_lam = repr(1.0 - lam)
    one_m_ab = repr(1.0 - alpha - beta)
    return f""",
    p AS (SELECT *, row_number() OVER ({W}) - 1 AS pos FROM panel),
    ew0 AS (SELECT symbol, var_pop(log_return) AS var0 FROM p WHERE pos BETWEEN 1 AND 60 GROUP BY symbol),
    eb AS (SELECT p.symbol, p.pos,
                  CASE WHEN p.pos = 0 THEN ew0.var0
                       ELSE {one_m_lam} * coalesce(log_return, 0.0) * coalesce(log_return, 0.0) END AS b
           FROM p LEFT JOIN ew0 USING (symbol)),
    ew(symbol, pos, s) AS (
        SELECT symbol, pos, b FROM eb WHERE pos = 0
        UNION ALL
        SELECT eb.symbol, eb.pos, {lam!r} * ew.s + eb.b
        FROM ew JOIN eb ON eb.symbol = ew.symbol AND eb.pos = ew.pos + 1),
    gv AS (SELECT symbol, avg((coalesce(log_return, 0.0) * {scale!r}) * (coalesce(log_return, 0.0) * {scale!r})) AS v0
           FROM p WHERE split = 'train' GROUP BY symbol),
    gb AS (SELECT p.symbol, p.pos,
                  gv.v0 * {one_m_ab} + {alpha!r} * (coalesce(log_return, 0.0) * {scale!r}) * (coalesce(log_return, 0.0) * {scale!r})
                  + CASE WHEN p.pos = 0 THEN {beta!r} * gv.v0 ELSE 0.0 END AS b
           FROM p LEFT JOIN gv USING (symbol)),
    ga(symbol, pos, s) AS (
        SELECT symbol, pos, b FROM gb WHERE pos = 0
        UNION ALL
        SELECT gb.symbol, gb.pos, {beta!r} * ga.s + gb.b
        FROM ga JOIN gb ON gb.symbol = ga.symbol AND gb.pos = ga.pos + 1),
    hs AS (SELECT symbol, avg(target_vol) AS my, avg(vol_d) AS m0, avg(vol_w) AS m1, avg(vol_m) AS m2,
                  covar_pop(vol_d, target_vol) AS s0, covar_pop(vol_w, target_vol) AS s1,
                  covar_pop(vol_m, target_vol) AS s2,
                  covar_pop(vol_d, vol_d) AS S00, covar_pop(vol_d, vol_w) AS S01, covar_pop(vol_d, vol_m) AS S02,
                  covar_pop(vol_w, vol_w) AS S11, covar_pop(vol_w, vol_m) AS S12, covar_pop(vol_m, vol_m) AS S22
           FROM p WHERE split = 'train' GROUP BY symbol),
    hc AS (SELECT symbol, m0, m1, m2, {har['b0']} AS b0, {har['b1']} AS b1, {har['b2']} AS b2, {har['b3']} AS b3 FROM hs),
    preds AS (
        SELECT symbol, date, split, 'naive' AS model, target_vol AS y_true, vol_realized AS y_pred FROM p
        UNION ALL
        SELECT symbol, date, split, 'rolling_mean_22', target_vol,
               avg(vol_realized) OVER ({W} ROWS BETWEEN 21 PRECEDING AND CURRENT ROW) FROM p
        UNION ALL
        SELECT p.symbol, date, split, 'ewma_094', target_vol, sqrt(ew.s) FROM p JOIN ew USING (symbol, pos)
        UNION ALL
        SELECT p.symbol, date, split, 'har_rv', target_vol,
               greatest(b0 + b1 * coalesce(vol_d, hc.m0) + b2 * coalesce(vol_w, hc.m1) + b3 * coalesce(vol_m, hc.m2), 0.0)
        FROM p JOIN hc USING (symbol)
        UNION ALL
        SELECT p.symbol, date, split, 'garch_11', target_vol, sqrt(ga.s) / {scale!r} FROM p JOIN ga USING (symbol, pos))"""


def with_preds(bars_sql: str) -> str:
    return f"WITH RECURSIVE {panel_ctes(bars_sql)}{preds_ctes()}"


def cls_cte() -> str:
    """Classification view of the forecasts: label = target_regime,
    score = forecast, pred = forecast above the regime threshold."""
    return """,
    cls AS (SELECT preds.symbol, preds.date, preds.split, preds.model, panel.target_regime AS label,
                   preds.y_pred AS score,
                   CASE WHEN preds.y_pred IS NOT NULL
                        THEN CAST(preds.y_pred > panel.regime_threshold AS INTEGER) END AS pred
            FROM preds JOIN panel ON preds.symbol = panel.symbol AND preds.date = panel.date)"""


def describe_sql(x: str, prefix: str = "") -> str:
    return (f"count({x}) AS {prefix}count, avg({x}) AS {prefix}mean, stddev_samp({x}) AS {prefix}std, "
            f"min({x}) AS {prefix}min, quantile_cont({x}, 0.25) AS {prefix}q25, "
            f"quantile_cont({x}, 0.5) AS {prefix}q50, quantile_cont({x}, 0.75) AS {prefix}q75, "
            f"max({x}) AS {prefix}max")


def acf_sql(source: str, expr: str, series: str, n_lags: int) -> str:
    lags = ", ".join(f"lag(_d, {k}) OVER ({W}) AS _l{k}" for k in range(1, n_lags + 1))
    sums = ", ".join(f"sum(_d * _l{k}) AS g{k}" for k in range(1, n_lags + 1))
    unions = " UNION ALL ".join(
        f"SELECT symbol, '{series}' AS series, {k} AS lag, g{k} / g0 AS acf, 1.96 / sqrt(CAST(n AS DOUBLE)) AS band FROM ag_{series}"
        for k in range(1, n_lags + 1))
    return f"""
    d_{series} AS (SELECT symbol, date, ({expr}) - avg({expr}) OVER (PARTITION BY symbol) AS _d
                   FROM {source} WHERE ({expr}) IS NOT NULL),
    l_{series} AS (SELECT symbol, _d, {lags} FROM d_{series}),
    ag_{series} AS (SELECT symbol, count(*) AS n, sum(_d * _d) AS g0, {sums} FROM l_{series} GROUP BY symbol),
    acf_{series} AS ({unions})"""


def residual_ctes(n_lags: int = 10) -> str:
    """Residual sufficient statistics per (symbol, model) on the test split; ends with ``rst``."""
    from ripplet.functions.special import chi2_sf_sql  # noqa: F401
    P = "PARTITION BY symbol, model"
    lags = ", ".join(f"lag(d, {k}) OVER ({P} ORDER BY date) AS l{k}" for k in range(1, n_lags + 1))
    sums = ", ".join(f"sum(d * l{k}) AS g{k}" for k in range(1, n_lags + 1))
    q = " + ".join(f"(g{k} / g0) * (g{k} / g0) / (n - {k})" for k in range(1, n_lags + 1))
    return f""",
    res AS (SELECT symbol, model, date, y_true - y_pred AS e,
                   CAST(row_number() OVER ({P} ORDER BY date) - 1 AS DOUBLE) AS t
            FROM preds WHERE split = 'test' AND y_true IS NOT NULL AND y_pred IS NOT NULL),
    rd AS (SELECT *, e * e AS u, t * t AS t2, e - avg(e) OVER ({P}) AS d FROM res),
    rl AS (SELECT *, {lags} FROM rd),
    rs AS (SELECT symbol, model, count(*) AS n, avg(e) AS mean, stddev_samp(e) AS std, min(e) AS min, max(e) AS max,
                  avg(d * d) AS m2, avg(d * d * d) AS m3, avg(d * d * d * d) AS m4,
                  var_pop(t) AS v11, var_pop(t2) AS v22, covar_pop(t, t2) AS v12,
                  covar_pop(t, u) AS c1, covar_pop(t2, u) AS c2, var_pop(u) AS vu,
                  sum(d * d) AS g0, {sums}
           FROM rl GROUP BY symbol, model),
    rst AS (SELECT symbol, model, n, mean, std, min, max,
                   m3 / power(m2, 1.5) AS skew_pop, m4 / (m2 * m2) - 3.0 AS kurt_pop,
                   n * (((c1 * v22 - c2 * v12) / (v11 * v22 - v12 * v12)) * c1
                        + ((c2 * v11 - c1 * v12) / (v11 * v22 - v12 * v12)) * c2) / vu AS white,
                   n * c1 * c1 / (v11 * vu) AS bp,
                   n * (n + 2) * ({q}) AS lb
            FROM rs),
    rst2 AS (SELECT *, n / 6.0 * (skew_pop * skew_pop + kurt_pop * kurt_pop / 4.0) AS jb FROM rst)"""


def residual_tests_select() -> str:
    from ripplet.functions.special import chi2_sf_sql
    rows = [("white", "white", 2), ("breusch_pagan", "bp", 1), ("ljung_box(lag=10)", "lb", 10), ("jarque_bera", "jb", 2)]
    return " UNION ALL ".join(
        f"SELECT symbol, model, '{name}' AS test, {c} AS statistic, {chi2_sf_sql(c, df)} AS p_value FROM rst2"
        for name, c, df in rows)
