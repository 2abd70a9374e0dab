"""Line dedup against a brute-force version: all pairs of distinct lines, exact Jaccard, plain union-find."""
from itertools import combinations

import numpy as np
import pytest

from ripplet.llm import lines
from ripplet.llm.common import local_components
from ripplet.sources.tables import read_table
from tests.conftest import SF_SMALL

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, removed_of long, key string, root int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 1, "k", 2) for i, t in rows], SCHEMA)


def brute(rows, shingle=7, threshold=0.8):
    places = [((i is None, i if i is not None else 0, n), x) for i, t in rows for n, x in enumerate((t or "").split("\n")) if x and not x.isspace()]
    distinct = sorted({x for _, x in places})
    parent = {x: x for x in distinct}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    sets = {x: {x[i:i + shingle] for i in range(max(1, len(x) - shingle + 1))} for x in distinct}
    for a, b in combinations(distinct, 2):
        A, B = sets[a], sets[b]
        if min(len(A), len(B)) >= threshold * max(len(A), len(B)) and len(A & B) >= threshold * len(A | B):
            parent[find(a)] = find(b)
    first = {}
    for p, x in places:
        first[find(x)] = min(first.get(find(x), p), p)
    return {(None if p[0] else p[1], p[2]) for p, x in places if first[find(x)] != p}


def got(df):
    return {(r.doc_id, n) for r in df.collect() for n in r.removed}


def test_equals_brute_force_on_the_table(spark):
    docs = read_table(spark, SF_SMALL, "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want, have = brute(rows), got(lines.dedup_lines(docs))
    assert have <= want and len(have) >= 0.995 * len(want)
    assert want


def test_edges(spark):
    long = " ".join(f"w{i}" for i in range(20_000))
    rows = [(1, "alpha beta gamma delta\nx\n\n  \nx"), (2, "alpha beta gamma delta"), (3, None), (4, ""), (None, "x\nnew line of text"),
            (5, long), (6, long + "!"), (7, "kept\nalpha beta gamma delta"), (7, "kept\nalpha beta gamma delta"), (8, "ab"), (9, "ab"), (10, "ac")]
    df = frame(spark, rows)
    out = {(r.doc_id, r.n_lines): list(r.removed) for r in lines.dedup_lines(df).collect()}
    assert out[(1, 5)] == [4] and out[(2, 1)] == [0] and out[(3, 0)] == [] and out[(4, 0)] == []
    assert out[(None, 2)] == [0] and out[(6, 1)] == [0] and out[(5, 1)] == [] and out[(7, 2)] == [1]
    assert out[(9, 1)] == [0] and out[(10, 1)] == []
    kept = lines.keep_first_lines(df)
    assert kept.columns == df.columns
    texts = [(r.doc_id, r.text) for r in kept.collect()]
    assert (1, "alpha beta gamma delta\nx\n\n  ") in texts and (3, None) in texts and (4, "") in texts and (None, "new line of text") in texts
    assert not {2, 6, 9} & {i for i, _ in texts} and texts.count((7, "kept")) == 2


def test_empty_table(spark):
    assert lines.dedup_lines(frame(spark, [])).count() == 0


def test_chain_in_a_bucket_keeps_its_links(spark):
    """A near-copy group whose ends are far apart is one component."""
    words = [f"word{i:03d}" for i in range(60)]
    rows = []
    for d in range(12):
        words[d * 3] = f"edit{d:03d}"
        rows.append((d, " ".join(words)))
    assert got(lines.dedup_lines(frame(spark, rows))) == brute(rows) == {(d, 0) for d in range(1, 12)}


@pytest.mark.parametrize("j", [0.8, 0.9])
def test_recall_of_the_banding(j):
    rng = np.random.default_rng(1)
    hit, n = 0, 400
    for _ in range(n):
        base = "".join(rng.choice(list("abcdefghij "), 220))
        cut = int(len(base) * (1 - j) / (1 + j)) if j < 1 else 0
        other = "".join(rng.choice(list("klmnop"), max(cut, 1))) + base[max(cut, 1):]
        s = lines.band_keys(lines.signatures([base, other], 7, 44), 11, 4)
        assert lines.jaccard(base, other, 7) >= j - 0.06
        hit += (s[0] == s[1]).any()
    assert hit >= 0.95 * n


def test_no_bucket_is_numbered_as_one_group(spark):
    keys = [bytes([i]) * 16 for i in range(30)]
    entries = [(k, [7]) for k in keys] + [(keys[4], [7])] * 2 + [(keys[0], [8]), (keys[0], [8]), (keys[1], [9, 10]), (keys[2], [9]), (keys[3], None), (keys[3], [])]
    got = lines._buckets(spark.createDataFrame(entries, "key binary, bands array<long>"))
    assert sorted((r.h, bytes(r.key), bytes(r.leader)) for r in got.collect()) == [(7, k, keys[4]) for k in keys] + [(9, k, keys[2]) for k in keys[1:3]]
    label = spark.createDataFrame([(7, k, k if i % 3 else keys[0], i % 3 > 0, 0.9) for i, k in enumerate(keys)], "h long, key binary, root binary, stray boolean, sim double")
    # lines 0..14 are near each other, as are 15..29: every cell joins what it holds, and no cell sends more edges than roots
    texts = spark.createDataFrame([(k, ("a" * 60 if i < 15 else "b" * 60) + "0123456789" + f"{i % 15:x}") for i, k in enumerate(keys)], "key binary, line string")
    cross = lines._cross_links(label, texts, 0.6, 7, block=2)  # many cells
    root = {k: k if i % 3 else keys[0] for i, k in enumerate(keys)}
    edges = [(bytes(r.a), bytes(r.b)) for r in cross.collect()]
    place = {r: i for i, r in enumerate(sorted(set(root.values())))}
    p = local_components(len(place), np.array([place[a] for a, _ in edges]), np.array([place[b] for _, b in edges]))
    group = [p[place[root[k]]] for k in keys]
    assert len({group[i] for i in range(15) if i % 3}) == 1 == len({group[i] for i in range(15, 30) if i % 3})
    assert len(edges) <= 20 * 30
    for df in (got, cross):
        assert "Window" not in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("alphabet", ["ab ", "abcdefghiñßé .,", "".join(map(chr, range(0x4E00, 0x4E00 + 3000)))])
def test_shingle_sets_are_exact_and_bounds_hold(alphabet):
    rng = np.random.default_rng(2)
    texts = ["a", "abc", "abcdefg", "\x00" * 9] + ["".join(rng.choice(list(alphabet), n)) for n in (3, 7, 8, 40, 300, 1000)]
    texts += [t[:20] + "x" + t[20:] for t in texts[-3:]]

    def shingles(t):
        return {t[i:i + 7] for i in range(max(1, len(t) - 6))}
    sets = lines.LineSets(texts, 7, bits=True)
    for i, x in enumerate(texts):
        for j, y in enumerate(texts):
            a, b = shingles(x), shingles(y)
            assert sets.jaccard(i, j) == len(a & b) / len(a | b) and sets.size[i] == len(a)
            assert np.bitwise_count(sets.bits[i] & ~sets.bits[j]).sum() <= len(a - b)


def test_only_bucket_keys_of_several_lines_are_in_the_table(spark):
    # packed by the tasks, not a row a key: lines that stand alone, however often, do not pass
    rng = np.random.default_rng(3)
    alone, shared = rng.integers(-1 << 63, 1 << 63, 400, dtype=np.int64).tolist(), rng.integers(-1 << 63, 1 << 63, 50, dtype=np.int64).tolist()
    rows = [(b"a%d" % i, [h]) for i, h in enumerate(alone)] * 2 + [(b"s%d-%d" % (k, i), [h]) for k in range(2) for i, h in enumerate(shared)]
    table = lines._several(spark.createDataFrame(rows, "key binary, bands array<long>").repartition(5)).table.value
    at = [(np.array(h, np.int64).view(np.uint64) >> np.uint64(64 - lines.FILTER_BITS)).astype(np.int64) for h in (alone, shared)]
    assert lines.BitTable.test(table, at[1]).all() and not lines.BitTable.test(table, at[0]).any()
    got = lines._buckets(spark.createDataFrame(rows, "key binary, bands array<long>").repartition(5)).collect()
    assert sorted((r.h, bytes(r.key)) for r in got) == sorted((h, b"s%d-%d" % (k, i)) for k in range(2) for i, h in enumerate(shared))
