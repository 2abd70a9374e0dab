"""Target-distribution importance resampling over hashed n-gram features.

Text is lower-cased (A-Z), words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``; the features of a text are all runs of 1 to
``longest`` words, joined by one space, repeats counted; a feature's bucket is its crc32 modulo ``buckets``.  The texts of
a batch are joined with a separator sentinel, one regular expression pass finds all words, ``searchsorted`` in the
document offsets gives each word its document, runs whose ends lie in different documents are masked, and ``bincount``
counts the rest.  Each text is read once: its sparse bucket counts go to a table from which both the corpus counts (exact
sums) and, with the gains known, the weights come.

A bucket's gain is floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))); a document's weight the floored mean
of its features' gains (no feature: 0); its score adds floor(-1000 ln(-ln((h + 0.5) / 2^32))), h from a hash of
``seed:doc_id`` (Gumbel noise, so the highest scores are a draw without replacement).  Of the N documents with ``least_words``
words the floor(N percent / 100) highest scores are drawn, ties to the smaller doc_id.

Ranks need no global sort: scores are integers within about +-100,000 by their formula, so their histogram is small at any
input size; it gives the cut and the rank at which each score starts, and only rows of equal score are sorted.

Defined results: null or empty texts have no features, weight 0 and are never drawn unless ``least_words`` is 0; a null
doc_id hashes as an empty one and loses ties; repeated rows are ranked one by one; empty tables give no rows or, as target,
T = 0; a text longer than a window is read in parts that overlap by ``longest - 1`` words; other columns are not read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ripplet.llm.words import cut_long, word_spans
from ripplet.session import materialize

WINDOW_BYTES = 1 << 21
MEMO = 1 << 20  # words whose crc32 a task remembers
SENTINEL = b"\x00"
WORD = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
_IS_WORD = np.array([WORD.match(bytes([b])) is not None for b in range(256)])


class _Memo(dict):
    """Feature bytes -> bucket, computed on first sight."""

    def __init__(self, buckets: int):
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        b = self[feature] = zlib.crc32(feature) % self.buckets
        return b


def _features(words: list[bytes], doc: np.ndarray, old: int, longest: int, memo: _Memo) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(document, bucket) of every run that ends after the first ``old`` words, one array a run length."""
    of_word = np.fromiter(map(memo.__getitem__, words), np.int64, len(words))
    yield doc[old:], of_word[old:]
    if longest < 2 or len(words) < 2:
        return
    names: dict[bytes, int] = {}
    number = np.fromiter((names.setdefault(w, len(names)) for w in words), np.int64, len(words))
    node = number
    for k in range(2, min(longest, len(words)) + 1):
        spots = len(words) - k + 1
        _, first, node = np.unique(node[:spots] * len(names) + number[k - 1:], return_index=True, return_inverse=True)
        keep = (doc[:spots] == doc[k - 1:]) & (np.arange(spots) + k > old)
        hashed = np.array([memo[b" ".join(words[i:i + k])] for i in first.tolist()], np.int64)
        yield doc[:spots][keep], hashed[node[keep]]


def _joined(texts: list[bytes], longest: int, memo: _Memo) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words a document, document and bucket of every feature) of a batch of texts."""
    blob = SENTINEL.join(texts)
    offsets = np.cumsum([0] + [len(t) + 1 for t in texts])
    words = WORD.findall(blob)
    starts, _ = word_spans(np.frombuffer(blob, np.uint8), _IS_WORD)
    doc = np.searchsorted(offsets, starts, side="right") - 1
    found = list(_features(words, doc, 0, longest, memo))
    return (np.bincount(doc, minlength=len(texts)), np.concatenate([d for d, _ in found]), np.concatenate([b for _, b in found]))


def _alone(text: bytes, longest: int, memo: _Memo, window: int) -> tuple[int, np.ndarray]:
    """(words, dense bucket counts) of one long text, part by part."""
    total, dense, carry = 0, np.zeros(memo.buckets, np.int64), []
    for part, _ in cut_long(text, window, _IS_WORD):
        words = carry + WORD.findall(part)
        total += len(words) - len(carry)
        for _, b in _features(words, np.zeros(len(words), np.int64), len(carry), longest, memo):
            dense += np.bincount(b, minlength=memo.buckets)
        carry = words[-(longest - 1):] if longest > 1 else []
    return total, dense


def bucket_counts(docs: DataFrame, longest: int = 1, buckets: int = 10_000, window: int = WINDOW_BYTES) -> DataFrame:
    """``(doc_id, n_words, n_features, at, n)``: the buckets of each document's features and their counts, sparse."""
    def rows(ids: list, n_words: np.ndarray, doc: np.ndarray, bucket: np.ndarray) -> pa.RecordBatch:
        key, n = np.unique(doc * buckets + bucket, return_counts=True)
        bounds = np.searchsorted(key, np.arange(len(ids) + 1) * buckets).astype(np.int32)
        feats = np.bincount(doc, minlength=len(ids))
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(n_words.astype(np.int64)), pa.array(feats.astype(np.int64)),
             pa.ListArray.from_arrays(bounds, pa.array((key % buckets).astype(np.int32))), pa.ListArray.from_arrays(bounds, pa.array(n.astype(np.int64)))],
            ["doc_id", "n_words", "n_features", "at", "n"])

    def run(batches):
        memo = _Memo(buckets)
        for b in batches:
            ids, texts, size = [], [], 0
            for i, text in enumerate(b.column(1)):
                raw = (text.as_py() or "").encode().lower()
                if len(raw) > window:
                    n_words, dense = _alone(raw, longest, memo, window)
                    at = np.flatnonzero(dense)
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).slice(i, 1), pa.array([n_words]), pa.array([int(dense.sum())]), pa.array([at.astype(np.int32)], pa.list_(pa.int32())),
                         pa.array([dense[at]], pa.list_(pa.int64()))], ["doc_id", "n_words", "n_features", "at", "n"])
                    continue
                ids.append(b.column(0)[i].as_py())
                texts.append(raw)
                size += len(raw)
                if size >= window:
                    yield rows(ids, *_joined(texts, longest, memo))
                    ids, texts, size = [], [], 0
            if ids:
                yield rows(ids, *_joined(texts, longest, memo))

    return (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
            .mapInArrow(run, "doc_id long, n_words long, n_features long, at array<int>, n array<long>"))


def corpus_counts(counted: DataFrame, buckets: int) -> np.ndarray:
    """Sum of all documents' counts: every task adds its rows up and sends at most one row a bucket; ``buckets`` rows reach the driver."""
    def run(batches):
        dense = np.zeros(buckets, np.int64)
        for b in batches:
            np.add.at(dense, b.column(0).flatten().to_numpy(), b.column(1).flatten().to_numpy())
        at = np.flatnonzero(dense)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(dense[at])], ["at", "n"])

    got = counted.select("at", "n").mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    dense = np.zeros(buckets, np.int64)
    dense[got["at"].to_numpy(np.int64)] = got["n"].to_numpy(np.int64)
    return dense


def bucket_gains(own: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the smoothed ratio of target to corpus frequency) of each bucket."""
    size, s_all, t_all = len(own), float(own.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + size) / ((s + 1.0) * (t_all + size))))
                     for s, t in zip(own.astype(float).tolist(), target.astype(float).tolist())], np.int64)


def importance_resample(docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = 10_000, least_words: int = 20,
                        percent: int = 10, seed: int = 2024) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every row of ``docs``; ``target`` needs a ``text`` column.  Rank is null for rows that are not drawn."""
    spark = docs.sparkSession
    counted = materialize(bucket_counts(docs, longest, buckets), "resample-counts", compression="zstd")
    aimed = bucket_counts(target.select(F.lit(None).cast("long").alias("doc_id"), "text"), longest, buckets)
    gains = bucket_gains(corpus_counts(counted, buckets), corpus_counts(aimed, buckets))

    def weigh(batches):
        for b in batches:
            n, at = b.column("n"), b.column("at")
            of = np.repeat(np.arange(len(b)), at.value_lengths().to_numpy())
            total = np.zeros(len(b), np.int64)
            np.add.at(total, of, gains[at.flatten().to_numpy()] * n.flatten().to_numpy())
            feats = b.column("n_features").to_numpy()
            weight = np.floor_divide(total, np.maximum(feats, 1))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("n_words"), b.column("n_features"), pa.array(weight)],
                                             ["doc_id", "n_words", "n_features", "weight"])

    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    scored = materialize(counted.mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long")
                         .withColumn("score", F.col("weight") + noise), "resample-scores")
    able = scored.where(F.col("n_words") >= least_words)
    hist = able.groupBy("score").count().toPandas().sort_values("score", ascending=False)
    many = hist["count"].to_numpy(np.int64)
    draw = int(many.sum()) * percent // 100
    before = np.cumsum(many) - many
    used = before < draw
    starts = [(int(s), int(b)) for s, b in zip(hist["score"][used], before[used])]
    places = spark.createDataFrame(starts, "score long, ahead long")
    inside = Window.partitionBy("score").orderBy(F.asc_nulls_last("doc_id"), "n_features")
    place = F.col("ahead") + F.row_number().over(inside)
    lowest = starts[-1][0] if starts else None
    names = ["doc_id", "n_words", "n_features", "weight", "score"]
    within = F.lit(False) if lowest is None else (F.col("n_words") >= least_words) & (F.col("score") >= lowest)
    top = (scored.where(within).join(F.broadcast(places), "score")  # a row a score, bounded by the range of scores
           .select(*names, F.when(place <= draw, place).cast("long").alias("rank")))
    return top.unionByName(scored.where(~within).select(*names, F.lit(None).cast("long").alias("rank")))
