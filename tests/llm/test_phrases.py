"""Collocations against plain counting of every phrase."""
import random
import re
from collections import Counter

import numpy as np
import pytest

from ripplet.llm import phrases, words
from ripplet.sources.tables import read_table
from tests.conftest import SF_SMALL


def slow_counts(rows, longest):
    f, n = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f.setdefault(lang, Counter())[tuple(w[i:i + k])] += 1
    return f, n


def brute(rows, longest, least, percent, top):
    f, n = slow_counts(rows, longest)
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        got = []
        for p, a in cand.items():
            if any(len(q) > len(p) and 100 * b >= percent * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in cand.items()):
                continue
            score, k = min((1000 * a * n[lang] // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            got.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(got)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def test_the_table(spark):
    docs = read_table(spark, SF_SMALL, "documents")
    rows = [(r.lang, r.text) for r in docs.collect()]
    for least, percent in ((20, 100), (8, 60)):
        got = phrases.collocations(docs, 5, least, percent, top=300, entries=5000)
        want = brute(rows, 5, least, percent, 300)
        assert len(want) > 20 and sorted(map(tuple, got.collect())) == want


def test_edges(spark):
    rows = [("en", None), (None, "a b a b. a\tb"), ("en", ""), ("en", " ;. "), ("en", "New  York, new york\nNew York"), ("en", "é ñ é ñ é ñ"),
            ("xx", "a a a a a a a"), ("en", "x y z x y z")] * 2 + [("fr", "w" * 300 + " q " + "w" * 300 + " q")]
    df = spark.createDataFrame([(a, b, 1, 2) for a, b in rows], "lang string, text string, n int, phrase int")
    for least in (1, 2, 5):
        got = phrases.collocations(df, 4, least, 100, 50)
        assert sorted(map(tuple, got.collect())) == brute(rows, 4, least, 100, 50)
    assert phrases.collocations(df.limit(0), 3, 1).count() == 0


@pytest.mark.parametrize("length", [1, 2, 4])
def test_a_long_text_is_counted_in_overlapping_parts(length):
    rng = random.Random(4)
    text = "".join(rng.choice(["a", "bb", "ccc", "d" * 40]) + rng.choice([" ", " ", "\t", "  ", ". ", "\n"]) for _ in range(3000)) + "e" * 500
    want = slow_counts([("en", text)], length)[0]["en"]
    got, total = Counter(), 0
    for names, rows, n, fresh in phrases._occurrences(text.encode(), length, np.uint64(1), None, 0, window=200):
        total += fresh
        for row, c in zip(rows.tolist(), n.tolist()):
            got[tuple(names[x].decode() for x in row)] += c
    assert got == Counter({p: c for p, c in want.items() if len(p) == length})
    assert total == len(re.findall(r"[^\s.]+", text))


def test_trie_bursts_and_gives_whole_subtrees():
    rng = random.Random(1)
    keys = [np.array([rng.randrange(5), rng.randrange(30), rng.randrange(30)], ">u4").tobytes() for _ in range(5000)]
    trie, want = phrases.HatTrie(burst=20), Counter(keys)
    for k in keys:
        trie.add(k[:4], [k[4:]], [1])
    assert type(trie.root) is dict and trie.size == len(want)
    def entries(taken):
        raw, counts = taken
        return Counter({raw[12 * i:12 * i + 12]: c for i, c in enumerate(counts)})
    run, left = entries(trie.take(0.5)), entries(trie.take(1.0))
    heads = {k[:4] for k in run}
    assert 0 < len(heads) < 5 and not heads & {k[:4] for k in left}   # whole subtrees leave
    assert run + left == want and trie.size == 0


def test_runs_round_trip():
    for texts, n in (([b"a"], [1]), ([b"a b", b"a c d", b"\xc3\xa9"], [255, 3, 1 << 40])):
        got, counts = phrases.unpack_run(phrases.pack_run(texts, np.array(n, np.int64)))
        assert got.to_pylist() == texts and counts.tolist() == n


def test_words_that_share_a_hash_are_told_apart(monkeypatch):
    flat = np.frombuffer(b"abc abd abc longword-longword abd", np.uint8)
    starts, ends = words.word_spans(flat, phrases._IS_WORD)
    for hashed in (words.hash_words, lambda f, s, e: np.zeros(len(s), np.uint64)):
        monkeypatch.setattr(words, "hash_words", hashed)
        number, names, _ = words.number_words(flat, starts, ends)
        assert [names[i] for i in number.tolist()] == flat.tobytes().split()
