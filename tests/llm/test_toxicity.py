"""Toxicity: the segment scan against brute force, and held-out accuracy."""
import random

from ripplet.llm import queries, toxicity
from ripplet.sources.tables import read_table

SF = "/root/testdata/sf0.01"


def brute_segments(scores):
    """Maximal segments by their definition: repeatedly the best segment (shortest, leftmost), then both sides."""
    def best(lo, hi):
        out = None
        for i in range(lo, hi):
            t = 0.0
            for j in range(i, hi):
                t += scores[j]
                if t > 1e-12 and (out is None or t > out[0] + 1e-9):
                    out = (t, i, j)
        return out

    def split(lo, hi):
        b = best(lo, hi)
        return [] if b is None else split(lo, b[1]) + [(b[1], b[2], b[0])] + split(b[2] + 1, hi)
    return split(0, len(scores))


def test_segment_scan():
    rng = random.Random(4)
    for _ in range(300):
        n, rest = rng.randint(0, 30), -rng.choice([0.25, 0.7, 1.3])
        marked = [(i, rng.choice([0.31, 1.07, 2.63]) + rng.random() / 50) for i in range(n) if rng.random() < 0.35]
        scores = [dict(marked).get(i, rest) for i in range(n)]
        got = toxicity.maximal_segments(marked, rest)
        want = brute_segments(scores)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
        assert all(abs(x - y) < 1e-9 for (_, _, x), (_, _, y) in zip(got, want))


def test_held_out_accuracy(spark):
    out = queries.op3_toxicity(spark, SF).join(read_table(spark, SF, "labels"), "doc_id").where("held_out").collect()
    toxic = [r for r in out if r.toxic == 1]
    clean = [r for r in out if r.toxic == 0]
    assert toxic and clean and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
    assert sum(r.predicted for r in clean) <= 0.02 * len(clean)
    auc = sum((a.score > b.score) + (a.score == b.score) / 2 for a in toxic for b in clean) / (len(toxic) * len(clean))
    assert auc > 0.8


def test_labels_of_the_fold_are_not_learnt(spark):
    docs = read_table(spark, SF, "documents")
    labels = read_table(spark, SF, "labels")
    flipped = labels.selectExpr("doc_id", "quality", "CASE WHEN crc32(CAST(doc_id AS STRING)) % 5 = 0 THEN 1 - toxic ELSE toxic END AS toxic")
    assert toxicity.fit(docs, labels) == toxicity.fit(docs, flipped)


def test_edges(spark):
    schema = "doc_id long, text string, toxicity string, label int"
    rows = [(i, ("you idiot fool " if i % 2 else "fine plain words ") * 3 + f"tail{i}", "x", 1) for i in range(60)]
    rows += [(100, None, "x", 1), (101, "", "x", 1), (None, "idiot", "x", 1), (5, rows[5][1], "x", 1), (102, "word " * 100_000, "x", 1)]
    docs = spark.createDataFrame(rows, schema)
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(None, 1), (999, 1), (3, 0), (4, None)], "doc_id long, toxic int")
    for used in (labels, labels.where("toxic = 0"), labels.limit(0)):
        out = toxicity.score_documents(docs, used)
        name = toxicity.score_name(docs)
        assert name == "toxicity_" and out.count() == len(rows)
        assert all(0 <= r[name].score <= 1 for r in out.collect())
    assert toxicity.score_documents(docs.limit(0), labels).count() == 0
    assert toxicity.fit(docs, labels.limit(0)) == toxicity.ToxicityModel()


def test_sample_is_bounded_in_rows_and_the_z_test_comes_before_the_limit(spark, monkeypatch):
    docs, labels = read_table(spark, SF, "documents"), read_table(spark, SF, "labels")
    full = toxicity.fit(docs, labels).weights
    assert full and toxicity.fit(docs, labels, max_features=len(full)).weights == full
    seen = []
    monkeypatch.setattr(toxicity, "_calibrate", lambda model, sample: seen.append(sample.count()) or model)
    one = docs.where("text <> ''").join(labels.where("toxic = 1 AND crc32(CAST(doc_id AS STRING)) % 5 <> 0"), "doc_id").limit(1).select("doc_id", "text")
    many = docs.select("doc_id", "text").union(one.selectExpr("doc_id", "explode(sequence(1, 5000)) AS i", "text").selectExpr("doc_id", "text || ' w' || i % 3000 AS text"))
    toxicity.fit(many, labels, max_labelled=600)
    plain = docs.select("doc_id", "text").union(docs.select("doc_id", "text"))
    toxicity.fit(plain, labels)
    toxicity.fit(docs, labels)
    assert seen[0] <= 600 and seen[1] == seen[2] and len(seen) == 3
