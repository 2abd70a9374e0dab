"""Small library functions: the feature list, the cleaned range, valid rows."""
from pyspark.sql import functions as F

from ripplet.operators.features import FEATURE_COLUMNS, build_features, feature_columns
from ripplet.operators.splits import valid_rows
from ripplet.sources.bars import clean_range


def test_feature_columns_are_what_the_builder_adds(bars):
    assert set(feature_columns(build_features(bars))) == set(FEATURE_COLUMNS)


def test_clean_range_keeps_rows_with_a_close_inside_the_dates(bars):
    span = bars.agg(F.min("date"), F.max("date")).first()
    mixed = bars.withColumn("close", F.when(F.dayofmonth("date") != 3, F.col("close")))
    lo, hi = str(span[0]), "1995-06-30"
    got = clean_range(mixed, lo, hi)
    assert got.where("close IS NULL").isEmpty() and str(got.agg(F.max("date")).first()[0]) <= hi
    assert got.count() == mixed.where(f"close IS NOT NULL AND date <= DATE '{hi}'").count() > 0


def test_valid_rows_need_every_target(spark):
    df = spark.createDataFrame([(1.0, 1), (None, 1), (2.0, None)], "target_vol double, target_regime int")
    assert valid_rows(df).count() == 2 and valid_rows(df, ("target_vol", "target_regime")).count() == 1
