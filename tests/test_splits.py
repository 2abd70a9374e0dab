"""Temporal split and fold-table invariants."""
from pyspark.sql import functions as F

from ripplet.operators.splits import temporal_split, time_series_folds


def test_split_disjoint_ordered_complete(bars):
    s = temporal_split(bars)
    assert s.count() == bars.count()
    r = s.groupBy("symbol", "split").agg(F.min("date").alias("lo"), F.max("date").alias("hi"),
                                         F.count(F.lit(1)).alias("n")).collect()
    by = {}
    for x in r:
        by.setdefault(x.symbol, {})[x.split] = x
    for sym, d in by.items():
        assert d["train"].hi < d["val"].lo and d["val"].hi < d["test"].lo
        n = sum(v.n for v in d.values())
        assert d["train"].n == int(n * 0.7) and d["val"].n == int(n * 0.15)


def test_fold_order_and_gap(bars):
    f = time_series_folds(bars, n_splits=3, gap=2)
    agg = f.groupBy("symbol", "fold", "role").agg(F.min("pos").alias("lo"), F.max("pos").alias("hi"),
                                                  F.count(F.lit(1)).alias("n")).collect()
    by = {}
    for x in agg:
        by[(x.symbol, x.fold, x.role)] = x
    for (sym, fold, role), x in by.items():
        if role == "test":
            tr = by[(sym, fold, "train")]
            assert tr.lo == 0 and tr.hi == x.lo - 3   # gap of 2 rows
            if (sym, fold + 1, "test") in by:
                assert by[(sym, fold + 1, "test")].lo == x.hi + 1


def test_purge_gap(bars):
    base = {(r.symbol, r.split): r.n for r in temporal_split(bars).groupBy("symbol", "split")
            .agg(F.count(F.lit(1)).alias("n")).collect()}
    pur = {(r.symbol, r.split): r.n for r in temporal_split(bars, purge=1).groupBy("symbol", "split")
           .agg(F.count(F.lit(1)).alias("n")).collect()}
    for (sym, sp), n in base.items():
        if sp == "train":
            assert pur[(sym, "train")] == n - 1 and pur[(sym, "purged")] == 1
        else:
            assert pur[(sym, sp)] == n
