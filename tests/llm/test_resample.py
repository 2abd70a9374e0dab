"""Importance resampling against a word-by-word version."""
import hashlib
import math
import re
import zlib
from collections import Counter

from ripplet.llm import resample
from ripplet.sources.tables import read_table
from tests.conftest import SF_SMALL


def slow_features(text, longest):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return words, [" ".join(words[i:i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)]


def brute(rows, aims, longest, buckets, least, percent, seed=2024):
    def at(f):
        return zlib.crc32(f.encode()) % buckets
    own, aim = Counter(), Counter(at(f) for t in aims for f in slow_features(t, longest)[1])
    for _, t in rows:
        own.update(at(f) for f in slow_features(t, longest)[1])
    s_all, t_all = sum(own.values()), sum(aim.values())
    out = []
    for d, t in rows:
        words, feats = slow_features(t, longest)
        gains = [math.floor(1000 * math.log((aim[at(f)] + 1.0) * (s_all + buckets) / ((own[at(f)] + 1.0) * (t_all + buckets)))) for f in feats]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append([d, len(words), len(feats), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    for i, r in enumerate(able[:len(able) * percent // 100]):
        r[5] = i + 1
    return sorted(map(tuple, out), key=repr)


def test_the_table_with_longer_runs(spark):
    docs, bench = read_table(spark, SF_SMALL, "documents"), read_table(spark, SF_SMALL, "benchmark")
    rows, aims = [tuple(r) for r in docs.select("doc_id", "text").collect()], [r.text for r in bench.collect()]
    for longest, buckets in ((1, 10_000), (3, 97)):
        got = resample.importance_resample(docs, bench, longest, buckets)
        assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, aims, longest, buckets, 20, 10)


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "one two Three"), (None, "one two three"), (4, "A1 b\x00c d-e"), (5, "x " * 40), (5, "x " * 40), (6, "été über ñ " * 9)]
    docs = spark.createDataFrame([(d, t, "a", 1) for d, t in rows], "doc_id long, text string, rank string, score int")
    aim = spark.createDataFrame([("one x été", 1)], "text string, doc_id int")
    for least, percent in ((0, 100), (1, 50), (20, 100)):
        got = resample.importance_resample(docs, aim, 2, 50, least, percent)
        assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, ["one x été"], 2, 50, least, percent)
    assert resample.importance_resample(docs.limit(0), aim).count() == 0
    assert resample.importance_resample(docs, aim.limit(0), 1, 50).count() == len(rows)


def test_long_texts_are_read_in_parts(spark):
    text = "".join(f"w{i % 97} " + ("- " if i % 5 == 0 else "") for i in range(4000)) + "z" * 900 + " end"
    docs = spark.createDataFrame([(1, text), (2, "w1 w2"), (3, text)], "doc_id long, text string")
    for longest in (1, 3):
        whole = sorted(map(tuple, resample.bucket_counts(docs, longest, 101).collect()))
        assert sorted(map(tuple, resample.bucket_counts(docs, longest, 101, window=300).collect())) == whole
