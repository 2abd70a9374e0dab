"""Nearest neighbours against brute force in double precision."""
import numpy as np

from ripplet.llm import neighbours
from ripplet.sources.tables import read_table
from tests.conftest import SF_SMALL


def brute(rows, k=5, every=50):
    ids = np.array([i for i, _ in rows], np.int64)
    v = np.array([x for _, x in rows], np.float64)
    norm = np.sqrt((v * v).sum(axis=1))
    out = {}
    for a in np.flatnonzero(ids % every == 0):
        s = (v * v[a]).sum(axis=1) / (norm * norm[a])
        keep = ids != ids[a]
        o = np.lexsort((ids[keep], -s[keep]))[:k]
        out[int(ids[a])] = list(zip(ids[keep][o].tolist(), s[keep][o].tolist()))
    return out


def check(df, want, recall=0.9):
    got = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score, r.rank))
    assert set(got) == {q for q, x in want.items() if x}
    hit = total = 0
    for q, x in want.items():
        assert [r for _, _, r in got.get(q, [])] == list(range(1, len(x) + 1))
        scores = dict(x)
        hit += len(scores.keys() & {i for i, _, _ in got.get(q, [])})
        total += len(x)
        for i, s, _ in got.get(q, []):
            assert i != q and (i not in scores or abs(scores[i] - s) < 1e-12)
    assert hit >= recall * total, hit / total
    return hit / total


def test_recall_on_the_table(spark):
    df = read_table(spark, SF_SMALL, "embeddings")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    check(neighbours.nearest_neighbours(df, "vec_id % 50 = 0"), brute(rows), 0.95)


def test_several_leaves_and_parts(spark):
    rng = np.random.default_rng(4)
    centre = rng.normal(size=(12, 16))
    rows = [(i, (centre[i % 12] + 0.4 * rng.normal(size=16)).tolist()) for i in range(1500)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    check(neighbours.nearest_neighbours(df, "vec_id % 50 = 0", leaf_rows=100), brute(rows))


def test_copies_ties_and_unusable_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0, 2.0]) for i in range(0, 400)] + [(1000 + i, [float(i), 1.0, -1.0]) for i in range(8)]
    bad = [(2000, None), (2050, [0.0, 0.0, 0.0]), (2100, [nan, 1.0, 1.0]), (2150, [inf, 1.0, 1.0]), (2200, [None, 1.0, 1.0]), (2250, [1.0, 2.0]), (None, [1.0, 1.0, 1.0])]
    df = spark.createDataFrame([(i, v, "q", 1.0) for i, v in rows + bad + rows[:3]], "vec_id long, embedding array<double>, v string, score double")
    out = neighbours.nearest_neighbours(df, "vec_id % 50 = 0")
    want = brute(rows)
    got = {}
    for r in sorted(out.collect(), key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == {q: [i for i, _ in x] for q, x in want.items()}
    assert got[0] == [1, 2, 3, 4, 5] and got[50] == [0, 1, 2, 3, 4]


def test_few_and_none(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (7, [0.5, 0.5])], "vec_id long, embedding array<float>")
    assert [(r.query_id, r.rank, r.vec_id) for r in neighbours.nearest_neighbours(few, "vec_id % 50 = 0").collect()] == [(0, 1, 7)]
    assert neighbours.nearest_neighbours(few.limit(0), "vec_id % 50 = 0").count() == 0
    assert abs(neighbours.chi2_quantile(0.95, 8) - 15.5073) < 1e-3


def test_lengths_are_classes_and_repeated_ids_keep_their_vectors(spark):
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=3 + i % 3).tolist()) for i in range(300)]
    rows += [(i, rng.normal(size=3).tolist()) for i in (0, 0, 50, 7, 7, 7, 7, 7, 7, 7, 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    cos = {}
    for a, x in rows:
        for b, y in rows:
            if a % 50 == 0 and a != b and len(x) == len(y):
                x_, y_ = np.array(x), np.array(y)
                cos[a, b] = max(cos.get((a, b), -2), float(x_ @ y_ / np.sqrt((x_ @ x_) * (y_ @ y_))))
    want = {a: sorted(((b, s) for (q, b), s in cos.items() if q == a), key=lambda t: (-t[1], t[0]))[:5] for a in range(0, 300, 50)}
    check(neighbours.nearest_neighbours(df, "vec_id % 50 = 0"), want, 0.95)
    check(neighbours.nearest_neighbours(df, "vec_id % 50 = 0", leaf_rows=40), want)
