"""Sources and sinks round-trips (A1, A2, A4, A6, A7) and the leakage audit."""
import os
import tempfile

from pyspark.sql import functions as F

from ripplet.operators.leakage import feature_leakage_audit
from ripplet.sources.bars import clean_range, read_ohlcv_csv
from ripplet.sources.io import read_json, read_parquet, write_json, write_parquet


def test_csv_panel_reader_and_range(spark, bars):
    d = tempfile.mkdtemp(prefix="ripplet-csv-")
    for sym in ("A", "N"):
        pdf = bars.where(F.col("symbol") == sym).orderBy("date").toPandas()
        pdf = pdf.rename(columns=str.capitalize)[["Date", "Open", "High", "Low", "Close", "Volume"]]
        pdf["OpenInt"] = 0
        pdf.to_csv(os.path.join(d, f"{sym.lower()}.us.txt"), index=False)
    df = read_ohlcv_csv(spark, os.path.join(d, "*.txt"))
    assert set(df.columns) == {"symbol", "date", "open", "high", "low", "close", "volume"}
    assert {r.symbol for r in df.select("symbol").distinct().collect()} == {"A", "N"}
    assert df.count() == bars.where(F.col("symbol").isin("A", "N")).count()
    rng = clean_range(df, "1996-01-01", "1996-12-31")
    r = rng.agg(F.min("date").alias("lo"), F.max("date").alias("hi")).first()
    assert str(r.lo) >= "1996-01-01" and str(r.hi) <= "1996-12-31"


def test_parquet_and_json_roundtrip(spark, bars):
    d = tempfile.mkdtemp(prefix="ripplet-io-")
    write_parquet(bars, os.path.join(d, "p"), ["symbol"])
    back = read_parquet(spark, os.path.join(d, "p"))
    assert back.count() == bars.count()
    j = bars.limit(5).withColumn("nothing", F.lit(None).cast("double"))
    write_json(j, os.path.join(d, "j"))
    raw = open([os.path.join(d, "j", f) for f in os.listdir(os.path.join(d, "j")) if f.endswith(".json")][0]).read()
    assert '"nothing":null' in raw
    assert read_json(spark, os.path.join(d, "j")).count() == 5


def test_leakage_audit_is_clean(bars):
    rows = feature_leakage_audit(bars).collect()
    assert rows and all(r.n_diff == 0 for r in rows)
