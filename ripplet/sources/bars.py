"""Sources: OHLCV CSV reader (A1), cleaning + range filter (A2) and
ticks -> OHLCV bars (A8).

Bars are a plain ``groupBy(symbol, bar).agg(...)``: every aggregate is
declarative, so Spark pre-aggregates map-side and only one row per
(symbol, bar) and map task crosses the shuffle, however hot a symbol is.
Open/close use ``min_by``/``max_by`` on a struct that totally orders the ticks
of a bar, so results do not depend on file or partition order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ripplet.functions.expr import ntz_to_micros
from ripplet.sources.tables import read_table

OHLCV_SCHEMA = T.StructType([
    T.StructField("Date", T.DateType()),
    T.StructField("Open", T.DoubleType()),
    T.StructField("High", T.DoubleType()),
    T.StructField("Low", T.DoubleType()),
    T.StructField("Close", T.DoubleType()),
    T.StructField("Volume", T.DoubleType()),
    T.StructField("OpenInt", T.DoubleType()),
])


def packed_order_key(cols: list[Column], digits: list[int]) -> Column:
    """Order-preserving DECIMAL(38,0) packing of non-negative integer keys.

    Lexicographic order of (k1, k2, ...) equals numeric order of the digit
    concatenation k1|k2|... when every k_i < 10^d_i.  A fixed-width decimal
    keeps ``min_by``/``max_by`` in a HashAggregate (a struct key forces a
    sort-based aggregate).  The concatenation is first assembled as two longs
    (the low 18 digits and the rest) with integer div/mod, so each row pays a
    single decimal multiply-add.  Out-of-range keys fail loudly."""
    total = sum(digits)
    if total > 38:
        raise ValueError("packed key wider than 38 digits")
    D = "decimal(38,0)"
    ok = None
    for c, d in zip(cols, digits):
        cond = (c >= 0) & (c < F.lit(str(10 ** d)).cast(D)) if d > 18 else (c >= 0) & (c < F.lit(10 ** d))
        ok = cond if ok is None else ok & cond
    bad = F.raise_error(F.lit("order key out of packed range")).cast(D)
    if total > 36 or any(d > 18 for d in digits):
        key = None
        for c, d in zip(cols, digits):
            scale = F.lit(str(10 ** d)).cast(D)
            v = c.cast(D)
            key = v if key is None else (key * scale + v).cast(D)
        return F.when(ok, key).otherwise(bad)
    lo, hi = F.lit(0).cast("bigint"), F.lit(0).cast("bigint")
    pos = 0  # digit position of the key's least significant digit, from the right
    for c, d in reversed(list(zip(cols, digits))):
        v = c.cast("bigint")
        if pos < 18:
            keep = min(d, 18 - pos)   # digits of this key that land in ``lo``
            lo = lo + (v % F.lit(10 ** keep)) * F.lit(10 ** pos)
            if keep < d:
                hi = hi + (v / F.lit(10 ** keep)).cast("bigint")   # exact: v // 10^keep for v >= 0
        else:
            hi = hi + v * F.lit(10 ** (pos - 18))
        pos += d
    key = (hi.cast(D) * F.lit(str(10 ** 18)).cast(D) + lo.cast(D)).cast(D)
    return F.when(ok, key).otherwise(bad)


def ohlcv_bars(ticks: DataFrame, symbol: str | Column, bar: str | Column,
               price: str | Column, order: list[str | Column],
               volume: Column | None = None, order_digits: list[int] | None = None) -> DataFrame:
    """Aggregate ticks into (symbol, bar, open, high, low, close, volume).

    ``order`` must totally order ticks inside a bar up to equal prices.  With
    ``order_digits`` (non-negative integer keys of known width) the order is
    packed into one decimal and the aggregate stays hash-based; otherwise a
    struct (with the price as last tie-breaker) is used."""
    col = lambda c: F.col(c) if isinstance(c, str) else c
    price_c = col(price)
    if order_digits:
        key = packed_order_key([col(c) for c in order], order_digits)
    else:
        key = F.struct(*[col(c) for c in order], price_c.alias("_p"))
    return (ticks
            .select(col(symbol).alias("symbol"), col(bar).alias("bar"),
                    price_c.alias("_price"), key.alias("_key"),
                    *( [] if volume is None else [volume.alias("_vol")] ))
            .groupBy("symbol", "bar")
            .agg(F.min_by("_price", "_key").alias("open"),
                 F.max("_price").alias("high"),
                 F.min("_price").alias("low"),
                 F.max_by("_price", "_key").alias("close"),
                 (F.sum("_vol") if volume is not None else F.count(F.lit(1)).cast("double"))
                 .alias("volume")))


def daily_bars_from_lineitem(spark: SparkSession, sf_dir: str,
                             symbol_cols: tuple[str, ...] = ("l_returnflag",)) -> DataFrame:
    """Canonical daily panel: symbol = return flag (or any lineitem key),
    date = ship date, price = extended price per unit, volume = quantity."""
    li = read_table(spark, sf_dir, "lineitem")
    sym = (F.col(symbol_cols[0]).cast("string") if len(symbol_cols) == 1
           else F.concat_ws("|", *[F.col(c).cast("string") for c in symbol_cols]))
    ticks = li.where(F.col("l_quantity") > 0)
    bars = ohlcv_bars(
        ticks, symbol=sym, bar=F.to_date("l_shipdate"),
        price=F.col("l_extendedprice") / F.col("l_quantity"),
        order=["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"],
        # Digit widths of the TPC-H key domains up to SF 100,000
        # (orderkey < 6e11, linenumber <= 7, partkey < 2e10, suppkey < 1e9).
        order_digits=[12, 1, 11, 10],
        volume=F.col("l_quantity"))
    return bars.withColumnRenamed("bar", "date")


EVENT_DIGITS = [18, 19]
# Half the range of 18 digits: dates from about 1200 BC to 16,000 AD keep their order as non-negative numbers.
EPOCH_OFFSET = 10 ** 17


def _event_order() -> list[Column]:
    """Total order of events: microseconds (time-zone free for TIMESTAMP_NTZ), then event_id."""
    return [ntz_to_micros(F.col("ts")) + F.lit(EPOCH_OFFSET), F.col("event_id")]


def event_order_key() -> Column:
    return packed_order_key(_event_order(), EVENT_DIGITS)


def hourly_bars_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streaming-shaped panel: symbol = event type, bar = hour of ``ts``,
    price = ``value``, volume = number of events."""
    ev = read_table(spark, sf_dir, "events")
    bars = ohlcv_bars(ev, symbol="event_type", bar=F.date_trunc("hour", "ts"),
                      price="value", order=_event_order(), order_digits=EVENT_DIGITS)
    return bars.withColumnRenamed("bar", "date")


def read_ohlcv_csv(spark: SparkSession, path: str, schema: T.StructType = OHLCV_SCHEMA,
                   symbol_from_file: bool = True) -> DataFrame:
    """A1: header CSV with a declared schema -> lower-case names, six columns.

    Many files form a panel; the symbol is the file's base name."""
    df = spark.read.schema(schema).option("header", True).csv(path)
    df = df.toDF(*[c.strip().lower() for c in df.columns])
    cols = ["date", "open", "high", "low", "close", "volume"]
    if symbol_from_file:
        base = F.element_at(F.split(F.input_file_name(), "/"), -1)
        sym = F.upper(F.regexp_replace(base, r"\..*$", ""))
        return df.select(sym.alias("symbol"), *cols)
    return df.select(*cols)


def clean_range(df: DataFrame, start: str = "1990-01-01", end: str = "2017-12-31",
                date_col: str = "date", close_col: str = "close") -> DataFrame:
    """A2: drop rows without a close; keep ``start <= date <= end``.

    Both predicates reach the parquet scan as pushed filters."""
    return (df.where(F.col(close_col).isNotNull())
              .where(F.col(date_col).between(F.lit(start).cast("date"), F.lit(end).cast("date"))))


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether the path (or glob) names anything on the file system that Spark itself reads."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def load_panel_bars(spark: SparkSession, sf_dir: str, csv_glob: str | None = None,
                    parquet_cache: str | None = None, start: str | None = None, end: str | None = None) -> DataFrame:
    """A3: source fallback with provenance.  Tries an OHLCV CSV panel, then a
    cached parquet panel, then derives bars from the ``lineitem`` transactions;
    the chosen leg is recorded in a literal ``source`` column.  Paths are looked
    up on Spark's own file system.  Rows without a close go; ``start`` / ``end``
    bound the dates only where given.
    (The reference's online-download and synthetic legs are not built.)"""
    if csv_glob and _exists(spark, csv_glob):
        bars, leg = read_ohlcv_csv(spark, csv_glob), "local_csv"
    elif parquet_cache and _exists(spark, parquet_cache):
        bars, leg = spark.read.parquet(parquet_cache), "parquet_cache"
    else:
        bars, leg = daily_bars_from_lineitem(spark, sf_dir), "lineitem_transactions"
    bars = bars.where(F.col("close").isNotNull())
    if start:
        bars = bars.where(F.col("date") >= F.lit(start).cast("date"))
    if end:
        bars = bars.where(F.col("date") <= F.lit(end).cast("date"))
    return bars.withColumn("source", F.lit(leg))
