"""SimHash against a bitwise fingerprint and all pairs of distinct fingerprints."""
import re

import numpy as np
import xxhash

from ripplet.llm import simhash
from ripplet.llm.common import connected_components, local_components
from ripplet.sources.tables import read_table
from tests.conftest import SF_SMALL


def slow_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0d]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 3]), 42) for i in range(max(1, len(words) - 2))] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    fp = np.array([slow_fingerprint(t) for _, t in rows], np.uint64)
    n, p = len(rows), np.arange(len(rows))
    for i in range(n):
        j = np.flatnonzero(np.bitwise_count(fp[i] ^ fp) <= 3)
        p = local_components(n, np.full(len(j), i), j, p)
    first = {}
    for r, (d, _) in zip(p.tolist(), rows):
        if d is not None:
            first[r] = min(first.get(r, d), d)
    return sorted(((d, f"{f:016x}", first.get(r)) for (d, _), f, r in zip(rows, fp.tolist(), p.tolist())), key=repr)


def test_the_table(spark):
    docs = read_table(spark, SF_SMALL, "documents").select("doc_id", "text")
    assert sorted((tuple(r) for r in simhash.simhash_dedup(docs).collect()), key=repr) == brute([tuple(r) for r in docs.collect()])


def test_edges_and_representatives(spark):
    rows = [(4, "A b C d e"), (3, "a B c d e"), (9, None), (8, ""), (7, " \t\n"), (5, "one"), (6, "one two"), (None, "one two"), (2, "long " * 50_000), (1, "Long " * 50_000), (1, "Long " * 50_000)]
    df = spark.createDataFrame([(i, t, 1, "f") for i, t in rows], "doc_id long, text string, representative int, fp string")
    out = sorted((tuple(r) for r in simhash.simhash_dedup(df).collect()), key=repr)
    assert out == brute(rows)
    kept = simhash.keep_representatives(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted([3, 7, 5, 6, 1, None], key=repr)
    assert simhash.simhash_dedup(df.limit(0)).count() == 0


def near(rng, centre, n, bits):
    out = []
    for _ in range(n):
        x = int(centre)
        for b in rng.choice(64, rng.integers(0, bits + 1), replace=False):
            x ^= 1 << int(b)
        out.append(x)
    return out


def test_trie_join_finds_every_pair():
    rng = np.random.default_rng(9)
    v = np.unique(np.array([x for c in rng.integers(0, 1 << 63, 30) for x in near(rng, c, 12, 4)], np.uint64))
    for chunk in (1 << 19, 50):
        got = {tuple(sorted(p)) for i, j in simhash.trie_join(v, 1, 3, chunk) for p in zip(i.tolist(), j.tolist())}
        want = {(i, j) for i in range(len(v)) for j in range(i + 1, len(v)) if int(v[i] ^ v[j]).bit_count() <= 3 and int(v[i] ^ v[j]) >> 63 == 0}
        assert got == want


def test_hot_roots_are_split_without_loss(spark):
    rng = np.random.default_rng(3)
    base = 0x123456789ABCDEF0
    values = sorted({int(x) for x in near(rng, base, 300, 6)} | {int(x) for x in rng.integers(0, 1 << 63, 100)})
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    comp = {}
    for limit in (50_000, 5):
        edges = simhash.link_fingerprints(df, 3, root_rows=limit, bucket_rows=200)
        comp[limit] = {(r.id, r.root) for r in connected_components(edges, "t").collect()}
    assert comp[50_000] == comp[5]
    v = np.array(values, np.uint64)
    p = np.arange(len(v))
    for i in range(len(v)):
        j = np.flatnonzero(np.bitwise_count(v[i] ^ v) <= 3)
        p = local_components(len(v), np.full(len(j), i), j, p)
    groups = {}
    for s, r in zip(signed, p.tolist()):
        groups.setdefault(r, []).append(s)
    assert comp[5] == {(s, min(g)) for g in groups.values() if len(g) > 1 for s in g}


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 400)] + [(1000, 1001), (7, 7)], "a long, b long")
    got = {r.id: r.root for r in connected_components(edges, "t").collect()}
    assert got == {**{i: 0 for i in range(401)}, 1000: 1000, 1001: 1000}
