"""Long-match removal against a brute-force version with a dictionary of all windows."""
import hashlib
import os
import random

import numpy as np

from ripplet.llm import suffix
from ripplet.sources.tables import read_table
from tests.conftest import SF_SMALL


def brute(rows, length=50):
    first = {}
    for d, t in rows:
        if d is not None:
            b = (t or "").encode()
            for i in range(len(b) - length + 1):
                w = b[i:i + length]
                first[w] = min(first.get(w, d), d)
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        if d is not None:
            for i in range(len(b) - length + 1):
                if first[b[i:i + length]] < d:
                    gone[i:i + length] = True
        edge = np.diff(np.concatenate(([0], gone.astype(int))))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((d, len(b), int(gone.sum()), int((edge == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def got(df, length=50):
    return sorted(((r.doc_id, r.n_bytes, sum(s.stop - s.start for s in r.spans), len(r.spans), hashlib.sha256(r.kept).hexdigest())
                   for r in suffix.cut_long_matches(df, length).collect()), key=repr)


def test_equals_brute_force_on_the_table(spark):
    docs = read_table(spark, SF_SMALL, "documents").select("doc_id", "text")
    assert got(docs) == brute([tuple(r) for r in docs.collect()])


def test_edges(spark):
    rng = random.Random(3)
    base = "".join(rng.choice("abcdé ") for _ in range(400))
    rows = [(5, base), (2, "x" + base[100:200] + "y"), (2, base[300:390]), (9, None), (10, ""), (11, base[100:149]), (12, base[100:151]),
            (None, base), (13, base[:60] * 3), (14, "z" * 500), (15, "z" * 49), (16, "z" * 50), (17, base), (17, base), (18, base[:60] + base[180:260])]
    df = spark.createDataFrame([(i, t, "s", 1) for i, t in rows], "doc_id long, text string, doc string, tid int")
    assert got(df) == brute(rows)
    assert got(df, 30) == brute(rows, 30)


def test_long_texts_are_cut_without_losing_a_window(spark, monkeypatch):
    rng = random.Random(11)
    base = "".join(rng.choice("abcd") for _ in range(1500))
    rows = [(1, base), (2, base[200:900] + "-" + base[:260]), (3, "q" * 700), (4, "q" * 60 + base[1400:]), (5, base[777:827]), (6, base[777:826])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    whole = list(suffix.bounded_rows(np.array([0, 10, 500, 520]), 50, 1000))
    assert [(x, y, i, k) for x, y, _, i, k in whole] == [(0, 520, 0, 0)]
    windows = [k + w for x, y, _, i, k in suffix.bounded_rows(np.array([0, 500]), 50, 120) for w in range(y - x - 49)]
    assert windows == list(range(451))
    shared = suffix.row_chunks
    monkeypatch.setattr(suffix, "row_chunks", lambda offsets, limit=None: shared(offsets, 120))
    cut = suffix.bounded_rows
    monkeypatch.setattr(suffix, "bounded_rows", lambda offsets, length: cut(offsets, length, 120))
    assert got(df) == brute(rows)


def test_empty_table(spark):
    assert got(spark.createDataFrame([], "doc_id long, text string")) == []


def test_index_is_a_bwt():
    rng = random.Random(5)
    strings = [bytes(rng.choice(b"ab") for _ in range(rng.randint(8, 70))) for _ in range(40)]
    strings += strings[:3]
    ix = suffix.RunLengthIndex(strings, 8)
    text = [(s[k:], i) for i, s in enumerate(strings) for k in range(len(s) + 1)]
    rows = sorted([b + 1 for b in s] + [0, i] for s, i in text)
    n = int(ix.size.sum())
    starts = np.cumsum(ix.size) - ix.size
    ends = np.append(ix.starts[1:], n) - 1
    for k in range(len(ix.starts)):
        i = int(np.searchsorted(starts, ix.samples[k], side="right")) - 1
        assert [b + 1 for b in strings[i][ix.samples[k] - starts[i]:]] + [0, i] == rows[ends[k]]
    for row in range(n):
        at = ix.locate(row)
        i = int(np.searchsorted(starts, at, side="right")) - 1
        assert [b + 1 for b in strings[i][at - starts[i]:]] + [0, i] == rows[row]
    s, o, first = ix.stream()
    assert len(s) == sum(max(0, len(x) - 7) for x in strings)
    for a, b, c in zip(s.tolist(), o.tolist(), first.tolist()):
        w = strings[a][b:b + 8]
        assert c == min(i for i, x in enumerate(strings) if w in x)


def test_few_anchors_pass_that_no_other_document_has(spark):
    # anchors are minima: hashes that crowd at the low end of the table let a third of all others pass
    rng = np.random.default_rng(8)
    n, bits = 8_000_000, suffix.TABLE_BITS
    low = np.min(rng.integers(0, 1 << 63, (n // 20, 17), dtype=np.uint64) * np.uint64(2), axis=1)
    places = np.stack(list(suffix.table_places((suffix.even(low) >> np.uint64(20)).astype(np.int64), 44, bits)))
    assert (places >= 0).all() and (places < 1 << bits).all()
    load = np.bincount(places[0] >> (bits - 6), minlength=64)
    assert load.max() < 1.1 * load.mean() and load.min() > 0.9 * load.mean()


def test_table_holds_the_shared_anchors(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(3000)) for _ in range(6)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(10, texts[0][:1500] + texts[3][500:])]
    table = suffix._shared_anchors(spark.createDataFrame(rows, "doc_id long, text string"), 50, 34, 21_000).table.value
    flat = np.frombuffer("".join(texts).encode(), np.uint8)
    h, row = suffix.Anchors(flat, np.arange(7) * 3000, 50).of(34)[3:]
    passing = np.ones(len(h), bool)
    for at in suffix.table_places((suffix.even(h) >> np.uint64(20)).astype(np.int64), 44, suffix.TABLE_BITS):
        passing &= suffix.BitTable.test(table, at)
    assert passing[row == 3].mean() > 0.8 and 0.45 < passing[row == 0].mean() < 0.55 and not passing[np.isin(row, [1, 2, 4, 5])].any()


def test_without_a_table_the_result_is_the_same(spark, monkeypatch):
    # a table of fixed size fills up: beyond TABLE_TEXT bytes of text the parts answer each group instead
    monkeypatch.setattr(suffix, "TABLE_TEXT", -1)
    docs = read_table(spark, SF_SMALL, "documents").select("doc_id", "text")
    assert got(docs) == brute([tuple(r) for r in docs.collect()])
    assert got(spark.createDataFrame([], "doc_id long, text string")) == []
    test_edges(spark)
    monkeypatch.setattr(suffix, "GROUP_BYTES", 300)
    test_edges(spark)
    test_long_texts_are_cut_without_losing_a_window(spark, monkeypatch)


def test_answers_hold_the_shared_anchors_only(spark, monkeypatch):
    rng = random.Random(6)
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(2000)) for _ in range(30)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(40, texts[0][500:1000] + texts[7][:300])]
    rows = suffix._rows(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    total = sum(len(t) for t in texts) + 800
    monkeypatch.setattr(suffix, "TABLE_BITS", 8)  # no size of the table matters
    monkeypatch.setattr(suffix, "GROUP_BYTES", 5000)
    bits = suffix.group_part_bits(total)
    groups = suffix.materialize(suffix._text_groups(rows, 50), "test-groups")
    answers = suffix._answers(groups, 50, 34, bits)
    pieces = suffix._answered_pieces(groups, answers, 50, 20, 34, bits, 4).toPandas()
    assert set(pieces["doc"]) == {0, 7, 40}
    # every window that two texts share is in a piece, at most one anchor's windows more at either end
    for doc, start, stop in ((0, 500, 1000), (7, 0, 300)):
        own = pieces[pieces["doc"] == doc].merge(pieces[["id", "s"]].dropna().drop_duplicates("id"), on="id")
        windows = {p + k for p, s in zip(own["start"], own["s_y"]) for k in range(len(s) - 49)}
        assert set(range(start, stop - 49)) <= windows <= set(range(max(0, start - 17), stop - 32))


def test_intermediate_files_are_given_up(spark):
    from ripplet import session
    spark.conf.set(session._RELEASE, "false")
    kept = session.materialize(spark.range(1000).repartition(4), "test-kept", release=True)
    assert spark.conf.get(session._RELEASE) == "false" and kept.count() == 1000
    folder = kept.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert os.path.isdir(folder)
    session.drop_table(kept)
    assert not os.path.exists(folder)
