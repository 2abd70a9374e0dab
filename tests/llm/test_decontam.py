"""Decontamination against a plain search of every window at every word."""
import hashlib
import re

from ripplet.llm import decontam, queries
from ripplet.sources.tables import read_table
from tests.conftest import SF_SMALL


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(docs, items, window):
    wins = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            wins.setdefault(tuple(w[k:k + window]), set()).add(i)
    out = []
    for d, t in docs:
        w, hit, names = words(t), set(), set()
        for size in {len(x) for x in wins}:
            for k in range(len(w) - size + 1):
                ids = wins.get(tuple(w[k:k + size]))
                if ids:
                    hit.update(range(k, k + size))
                    names |= {str(i) for i in ids if i is not None}
        out.append((d, len(w), len(hit), sorted(names)))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.doc_id, r.n_words, sum(s.stop - s.start for s in r.hits), list(r["items"])) for r in df.collect()), key=repr)


def test_the_table(spark):
    docs, items = read_table(spark, SF_SMALL, "documents"), read_table(spark, SF_SMALL, "benchmark")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute(rows, [tuple(r) for r in items.select("item_id", "text").collect()], 10)
    assert got(decontam.find_windows(docs, items)) == want and any(n for _, _, n, _ in want)
    out = {r.doc_id: (r.n_items, r.items_sha256, r.contaminated) for r in queries.op9_decontamination(spark, SF_SMALL).collect()}
    assert out == {d: (len(x), hashlib.sha256(",".join(x).encode()).hexdigest(), n > 0) for d, _, n, x in want}
    clean = {r.doc_id for r in decontam.keep_clean(docs, items).collect()}
    assert clean == {d for d, _, n, _ in want if n == 0}


ITEMS = [(2, "a b c d e f g h i j k"), (10, "Short item"), (11, None), (12, "..."), (13, "one"), (14, "x y z x y z x y z x y z x y z"), (2, "dup ID words here"),
         (15, "É ß ümlaut 12 34"), (16, "Short item"), (None, "null id item")]
DOCS = [(1, "A b c D e f g h i j k l"), (2, "a,b.c d e-f g h i j"), (3, "short\nITEM! short item"), (4, None), (5, ""), (6, "..."), (7, "x y z " * 9), (8, "É ß ümlaut 12 34"),
        (9, "é ß ümlaut 12 34"), (None, "one"), (3, "one more one"), (20, "w " * 60_000 + "dup id words here"), (21, "a b c d e f g h i"), (22, "null id item"), (23, "hort item")]


def test_edges(spark):
    docs = spark.createDataFrame([(d, t, "h") for d, t in DOCS], "doc_id long, text string, hits string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    want = brute(DOCS, ITEMS, 10)
    assert got(decontam.find_windows(docs, items)) == want
    assert got(decontam.find_windows(docs, items, block_bytes=20)) == want  # many blocks, merged
    clean = [r.doc_id for r in decontam.keep_clean(docs, items, block_bytes=20).collect()]
    assert sorted(clean) == sorted(d for d, _, n, _ in want if n == 0)
    assert decontam.find_windows(docs.limit(0), items).count() == 0
    assert all(n == 0 for _, _, n, _ in got(decontam.find_windows(docs, items.limit(0))))
