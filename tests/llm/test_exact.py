"""Exact dedup against a dictionary of normalised texts; fingerprints against big-integer arithmetic."""
import hashlib
import random
import re

import numpy as np
import pytest

from ripplet.llm import exact
from ripplet.sources.tables import read_table
from tests.conftest import SF_SMALL


def brute(rows):
    body = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    groups = {}
    for (d, _), t in zip(rows, body):
        groups.setdefault(t, []).append(d)
    out, led = [], set()
    for (d, _), t in zip(rows, body):
        ids = [x for x in groups[t] if x is not None]
        keep = min(ids) if ids else None
        kept = d == keep and t not in led
        if kept:
            led.add(t)
        out.append((d, keep, len(groups[t]), kept, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


EDGES = [(1, None), (2, ""), (3, " "), (4, "\n\t "), (5, "a b"), (6, "a  \x0b b"), (7, " a b"), (8, "a b"), (9, "A b"), (None, "a b"), (5, "a b"), (5, "a b"),
         (None, "only"), (None, "only"), (20, "x" * 70_000 + " y"), (21, "x" * 70_000 + "\ty"), (22, "x" * 70_000 + " z"), (23, "ü ñ" * 9), (24, "ü\nñ" * 9)]


def test_the_table(spark):
    docs = read_table(spark, SF_SMALL, "documents")
    assert rows_of(exact.exact_groups(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("huge,primes", [(exact.HUGE, exact.PRIMES), (1000, exact.PRIMES), (exact.HUGE, (2, 3)), (1000, (2, 1))])
def test_edges_huge_texts_and_colliding_fingerprints(spark, huge, primes):
    rng = random.Random(3)
    rows = EDGES + [(100 + i, "".join(rng.choice("ab ") for _ in range(3))) for i in range(80)]
    df = spark.createDataFrame([(d, t, "c", 1) for d, t in rows], "doc_id long, text string, fp string, kept int")
    assert rows_of(exact.exact_groups(df, huge, primes)) == brute(rows)
    assert exact.exact_groups(df.limit(0), huge, primes).count() == 0


def slow_print(body, prime):
    v = 0
    for b in body:
        v = (v * exact.BASE + b + 1) % prime
    return v


def test_prints_compose_and_equal_the_plain_polynomial():
    rng = random.Random(8)
    bodies = [bytes(rng.randrange(256) for _ in range(n)) for n in (0, 1, 7, 4095, 4096, 4097, 20_000)]
    got = exact.text_prints(np.frombuffer(b"".join(bodies), np.uint8), np.cumsum([0] + [len(b) for b in bodies]))
    for body, x in zip(bodies, got.tolist()):
        for j, prime in enumerate(exact.PRIMES):
            assert x[2 * j:2 * j + 2] == [slow_print(body, prime), pow(exact.BASE, len(body), prime)]
    a, b = got[3].tolist(), got[6].tolist()
    for j, prime in enumerate(exact.PRIMES):
        both = exact.combine((a[2 * j], a[2 * j + 1]), (b[2 * j], b[2 * j + 1]), prime)
        assert both == (slow_print(bodies[3] + bodies[6], prime), pow(exact.BASE, 4095 + 20_000, prime))
