"""Toxicity by maximum-scoring segments of token log-odds, calibrated with extreme-value statistics.

1. Features of a token (a run of letters, lower-cased) are the word and its prefixes of 4 to 7 letters.  Their counts
   in toxic and other labelled documents (different contexts, so that copies of a passage count once) come from at most ``max_labelled`` training rows (the smallest hashes
   of doc_id, equal rows of a doc_id once; the only sample), and the prior of each feature from its count over ALL documents.
2. log-odds with an informative Dirichlet prior (mass ``prior_mass`` spread as the corpus counts, plus 1/2) and their
   z-score keep the features that
   speak for toxicity; a token scores its best feature, any other token the (negative) log-odds of carrying none.
3. A linear-time scan finds every maximal-scoring segment of a text.  Under the clean model the best of n tokens
   follows an extreme-value law with E = K n exp(-lambda S); lambda solves sum p exp(lambda s) = 1 and K is fitted on
   clean training documents.  Segments with E <= ``max_e`` are the significant passages.
4. A two-feature logistic fit (-log E of the best segment, significant score per token) gives the score in 0..1.

Null and empty texts have no token and score as such (never an error); repeated rows are scored each; labels without a
document, or of a null doc_id, are unused; conflicting labels of a doc_id count as toxic.  With only one class among the
labels, or no label, there is no feature and every score is 0.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ripplet.llm.common import BitTable, fresh_name
from ripplet.session import materialize

TOKEN = re.compile(r"[^\W\d_]+")
PREFIXES = range(4, 8)
CACHE_ENTRIES = 300_000
FILTER_BITS = 22
PASSAGES = "score double, passages array<struct<start:int,stop:int,score:double>>"


def features(word: str) -> list[str]:
    return [word] + [word[:k] + "*" for k in PREFIXES if len(word) >= k]


def maximal_segments(scores: list[tuple[int, float]], rest: float) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first, last token, score) of a text in linear time.  ``scores``: the positive
    tokens in order; every token between two of them scores ``rest`` (negative)."""
    found: list[list[float]] = []  # [first, last, sum left of it, sum up to its end]
    total, before = 0.0, None
    for at, s in scores:
        if before is not None:
            total += rest * (at - before - 1)
        before = at
        first, left = at, total
        total += s
        last, right = at, total
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= left:
                j -= 1
            if j < 0 or found[j][3] >= right:
                found.append([first, last, left, right])
                break
            first, left = found[j][0], found[j][2]
            del found[j:]
    return [(int(a), int(b), r - x) for a, b, x, r in found]


@dataclass
class ToxicityModel:
    weights: dict[str, float] = field(default_factory=dict)
    rest: float = -1.0
    lam: float = 1.0
    log_k: float = 0.0
    coef: tuple[float, float, float] | None = None  # intercept, -log E, significant score per token
    max_e: float = 0.05

    def token_score(self, word: str) -> float:
        return max((self.weights[f] for f in features(word) if f in self.weights), default=0.0)

    def evidence(self, text: str | None, cache: dict[str, float]):
        """(-log E of the best segment, significant score per token, [(first, last token, score)])."""
        words = TOKEN.findall((text or "").lower())
        if len(cache) > CACHE_ENTRIES:
            cache.clear()
        for w in set(words).difference(cache):
            cache[w] = self.token_score(w)
        marked = [(i, s) for i, s in enumerate(map(cache.__getitem__, words)) if s]
        log_n = math.log(len(words) + 1)
        if not marked:
            return -self.log_k - log_n, 0.0, []
        segments = maximal_segments(marked, self.rest)
        strong = [x for x in segments if self.lam * x[2] - self.log_k - log_n >= -math.log(self.max_e)]
        best = max(x[2] for x in segments)
        return self.lam * best - self.log_k - log_n, sum(x[2] for x in strong) / len(words), strong

    def score(self, x: float, density: float) -> float:
        if self.coef is None:
            return 0.0
        a, b, c = self.coef
        return 1 / (1 + math.exp(-min(max(a + b * x + c * density, -60), 60)))


def score_column(model, text_col):
    """Struct column (score, passages in code points of the lower-cased text) for a broadcast ToxicityModel."""
    @F.pandas_udf(PASSAGES)
    def score(texts: pd.Series) -> pd.DataFrame:
        m, cache = model.value, {}
        scores, passages = [], []
        for t in texts:
            x, density, strong = m.evidence(t, cache)
            scores.append(m.score(x, density))
            if strong:
                at = [y.span() for y in TOKEN.finditer(t.lower())]
                strong = [{"start": at[a][0], "stop": at[b][1], "score": s} for a, b, s in strong]
            passages.append(strong)
        return pd.DataFrame({"score": pd.Series(scores, dtype="float64"), "passages": pd.Series(passages, dtype="object")})
    return score(text_col.cast("string"))


def _corpus_counts(docs: DataFrame, bits) -> DataFrame:
    """(feature, n): occurrences over all documents of the features that the broadcast bit table lets pass; '' counts all
    tokens.  Added up inside each batch, so the shuffle and the result are bounded by the number of features."""
    def run(batches):
        table, passing = bits.value, {}
        for b in batches:
            words: Counter = Counter()
            for t in b.column(0).to_pylist():
                if t:
                    words.update(TOKEN.findall(t.lower()))
            rows: Counter = Counter({"": words.total()})
            if len(passing) > CACHE_ENTRIES:
                passing.clear()
            for w, n in words.items():
                known = passing.get(w)
                if known is None:
                    at = [(f, zlib.crc32(f.encode("utf-8", "surrogatepass")) & ((1 << FILTER_BITS) - 1)) for f in features(w)]
                    known = passing[w] = [f for f, x in at if table[x >> 5] >> (x & 31) & 1]
                for f in known:
                    rows[f] += n
            yield pa.RecordBatch.from_arrays([pa.array(list(rows), pa.string()), pa.array(list(rows.values()), pa.int64())], ["feature", "n"])
    return docs.select("text").mapInArrow(run, "feature string, n long").groupBy("feature").agg(F.sum("n").alias("n"))


def _class_counts(sample: DataFrame) -> DataFrame:
    """(feature, toxic, n): in how many different contexts (the word before) the feature's words stand in each class.
    Counting contexts instead of occurrences makes a passage that many copies share count once."""
    def run(batches):
        for b in batches:
            seen = set()
            for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words = TOKEN.findall((t or "").lower())
                seen.update(zip([""] + words, words, [y] * len(words)))
            prev, word, toxic = zip(*seen) if seen else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(prev, pa.string()), pa.array(word, pa.string()), pa.array(toxic, pa.int32())], ["prev", "word", "toxic"])
    contexts = sample.mapInArrow(run, "prev string, word string, toxic int").distinct().groupBy("word", "toxic").agg(F.count("*").alias("n"))
    prefixes = [F.when(F.length("word") >= k, F.concat(F.substring("word", 1, k), F.lit("*"))) for k in PREFIXES]
    return (contexts.select(F.explode(F.array(F.lit(""), F.col("word"), *prefixes)).alias("feature"), "toxic", "n")
            .where("feature IS NOT NULL").groupBy("feature", "toxic").agg(F.sum("n").alias("n")))


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = 20_000, max_features: int = 20_000, min_count: int = 6,
        min_z: float = 3.0, prior_mass: float = 1000.0) -> ToxicityModel:
    """Model from training labels (crc32 of doc_id as text, modulo 5, not 0) and the counts of the whole corpus."""
    train = (labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL AND crc32(CAST(CAST(doc_id AS BIGINT) AS STRING)) % 5 <> 0")
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled))  # bounds what is broadcast
    train = materialize(train, "toxic-labels")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # equal rows of a doc_id count once, and a doc_id with many texts does not take the sample beyond its bound
    named = rows.withColumn("t", F.xxhash64("text")).join(F.broadcast(train), "doc_id")
    chosen = named.select("doc_id", "t").distinct().orderBy(F.xxhash64("doc_id", "t"), "doc_id", "t").limit(max_labelled)
    sample = materialize(named.join(F.broadcast(chosen), ["doc_id", "t"], "left_semi").dropDuplicates(["doc_id", "t"]).select("text", "toxic"), "toxic-sample")
    counted = materialize(_class_counts(sample), "toxic-contexts")
    totals = {r.toxic: r.n for r in counted.where("feature = ''").collect()}
    if not totals.get(0) or not totals.get(1):
        return ToxicityModel()
    by_class = (counted.where("feature <> ''").groupBy("feature")
                .agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("bad"), F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("good"))
                .where((F.col("bad") >= min_count) & (F.col("bad") * totals[0] > 2 * F.col("good") * totals[1])))
    by_class = materialize(by_class, "toxic-features")
    mask = F.lit((1 << FILTER_BITS) - 1)
    bits = BitTable.of(by_class.select(F.crc32(F.col("feature").cast("binary")).bitwiseAND(mask).alias("at")), FILTER_BITS)
    corpus = materialize(_corpus_counts(rows, bits.table), "toxic-corpus")
    n_corpus = corpus.where("feature = ''").first()["n"]
    n1, n0 = totals[1] + prior_mass, totals[0] + prior_mass
    # the test comes before the limit, which bounds the model that is broadcast
    tested = by_class.join(corpus, "feature", "left").select("feature", "bad", "good", F.coalesce("n", F.lit(0)).alias("n"))
    alpha = F.lit(float(prior_mass)) * F.col("n") / F.lit(n_corpus) + 0.5
    x, y = F.col("bad") + alpha, F.col("good") + alpha
    z = (F.log(x / (F.lit(n1) - x)) - F.log(y / (F.lit(n0) - y))) / F.sqrt(1 / x + 1 / y)
    tested = tested.where(z >= min_z - 1e-9).orderBy(F.desc("bad"), "feature").limit(max_features).collect()
    weights = {}
    for f, bad, good, n in tested:
        alpha = prior_mass * n / n_corpus + 0.5
        bad, good = bad + alpha, good + alpha
        delta = math.log(bad / (n1 - bad)) - math.log(good / (n0 - good))
        if delta > 0 and delta / math.sqrt(1 / bad + 1 / good) >= min_z:
            weights[f] = delta
    model = ToxicityModel(weights)
    if not weights:
        return model
    return _calibrate(model, sample)


def _calibrate(model: ToxicityModel, sample: DataFrame) -> ToxicityModel:
    """rest, lambda, K and the logistic fit, from the (bounded) labelled sample."""
    shared = sample.sparkSession.sparkContext.broadcast(model)

    def histogram(batches):
        for b in batches:
            m, out = shared.value, Counter()
            for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for w, n in Counter(TOKEN.findall((t or "").lower())).items():
                    out[y, round(m.token_score(w), 3)] += n
            yield pa.RecordBatch.from_arrays([pa.array([y for y, _ in out], pa.int32()), pa.array([s for _, s in out], pa.float64()),
                                              pa.array(list(out.values()), pa.int64())], ["toxic", "s", "n"])
    hist = sample.mapInArrow(histogram, "toxic int, s double, n long").groupBy("toxic", "s").agg(F.sum("n").alias("n")).toPandas()
    n = hist.groupby("toxic")["n"].sum()
    none = hist[hist["s"] == 0].groupby("toxic")["n"].sum().reindex([0, 1]).fillna(0)
    model.rest = min(-1e-4, math.log((none[1] + 1) / (n[1] + 2)) - math.log((none[0] + 1) / (n[0] + 2)))
    clean = hist[hist["toxic"] == 0]
    p, s = clean["n"].to_numpy() / n[0], np.where(clean["s"] > 0, clean["s"], model.rest)
    lo, hi = 0.0, 1.0
    if (s > 0).any() and p @ s < 0:
        while p @ np.exp(hi * s) < 1:
            hi *= 2
        for _ in range(60):
            mid = (lo + hi) / 2
            lo, hi = (lo, mid) if p @ np.exp(mid * s) > 1 else (mid, hi)
        model.lam = hi
    first = sample.sparkSession.sparkContext.broadcast(model)

    def evidence(batches):
        cache: dict[str, float] = {}
        for b in batches:
            got = [first.value.evidence(t, cache)[:2] for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array([x for x, _ in got], pa.float64()), pa.array([d for _, d in got], pa.float64())], ["toxic", "x", "d"])
    data = sample.mapInArrow(evidence, "toxic int, x double, d double").groupBy("toxic", "x", "d").agg(F.count("*").alias("n")).toPandas()
    data = data.sort_values(["toxic", "x", "d"])
    some = data[(data["toxic"] == 0) & (data["d"] > 0)]
    model.log_k = float(np.average(some["x"], weights=some["n"]) - np.euler_gamma) if some["n"].sum() >= 30 else 0.0
    x = np.column_stack([np.ones(len(data)), data["x"] - model.log_k, data["d"]])
    y = data["toxic"].to_numpy(float)
    n = data["n"].to_numpy(float)
    spread = np.sqrt(np.average((x[:, 1:] - np.average(x[:, 1:], axis=0, weights=n)) ** 2, axis=0, weights=n))
    scale = np.concatenate(([1.0], np.maximum(spread, 1e-9)))
    z, w, total = x / scale, np.zeros(3), n.sum()
    for _ in range(50):  # Newton steps with a small ridge, so that separable classes have a finite fit
        q = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (n * q * (1 - q))[:, None]).T @ z + 1e-3 * total * np.diag([0, 1, 1]) / 10 + 1e-9 * np.eye(3),
                               z.T @ (n * (y - q)) - 1e-3 * total / 10 * np.array([0, 1, 1]) * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    model.coef = tuple((w / scale).tolist())
    return model


def score_name(docs: DataFrame) -> str:
    """Name of the column that score_documents adds: ``toxicity``, unless the rows have one."""
    return fresh_name(docs, "toxicity")


def score_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``docs`` with one more column (see score_name) of score and passages."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, **options))
    return docs.withColumn(score_name(docs), score_column(model, F.col("text")))
