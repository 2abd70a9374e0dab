"""Physical-plan checks: pruning, pushdown, shuffles, no single-partition windows."""
import re

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def plan_of(spark, name):
    # Cached relations from earlier tests would be substituted into the plan
    # (and their inner plans printed); check the query's own plan.
    spark.catalog.clearCache()
    df = E.queries()[name](spark, SF)
    df.write.format("noop").mode("overwrite").save()   # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


def test_panel_plan(spark):
    p = plan_of(spark, "panel_daily")
    assert len(re.findall(r"FileScan parquet|Scan parquet", p)) == 1
    read = re.search(r"FileScan parquet \[([^\]]*)\]", p).group(1)
    assert len(read.split(",")) == 8                                  # 8 of 11 lineitem columns
    assert "GreaterThan(l_quantity,0.0)" in p                        # filter pushed into the scan
    assert "SortAggregate" not in p and "HashAggregate" in p         # packed key keeps hash aggregation
    assert p.count("Exchange hashpartitioning") <= 2                 # bars + one symbol partitioning
    assert "SinglePartition" not in p


@pytest.mark.parametrize("name", ["forecast_summary", "dm_pairs", "delong_pairs", "residual_tests"])
def test_forecast_family_scans_once(spark, name):
    p = plan_of(spark, name)
    assert len(re.findall(r"FileScan parquet|Scan parquet", p)) == 1
    assert "SinglePartition" not in p
