"""SimHash near-dedup: 64-bit fingerprints of word shingles, linked by a binary-trie self-join.

Contract of the fingerprint: A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``, ``shingle``-word shingles with repeats,
joined by one space (fewer words: the whole sequence; no word, empty or null text: fingerprint zero, linked like any
other).  A bit is set if it is set in over half of the shingles' XXH64 values (seed 42).

Links (``max_bits`` or fewer differing bits) are found exactly.  The 64 bits are cut into ``max_bits + 1`` blocks; two
linked fingerprints agree in one block at least, so each rotation that puts a block first gives tries whose roots are
the values of that block, and a linked pair meets below one root.  Inside a root the join walks pairs of trie nodes,
adds up the differing bits of the two paths and drops a pair once they exceed the budget.  Only distinct fingerprints
enter, so copies cost nothing; a root with more than ``root_rows`` fingerprints is dealt out by pairs of next-level
nodes within the budget.  Ties and repeated rows need no rule: every row gets the component of its fingerprint.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ripplet.llm.common import connected_components, fresh_name, local_components
from ripplet.session import materialize

SEED = 42
SPLIT_BITS = 6
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1)[:, ::-1].astype(np.int64)


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Unsigned 64-bit fingerprint of one text."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined, k = b" ".join(words), min(shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    spans = zip(starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist())
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(joined[s:e], SEED) for s, e in spans), np.uint64, len(words) - k + 1)
    parts = h.view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(parts[:, b], minlength=256) @ _BYTE_BITS for b in range(8)])
    return int(sum(1 << i for i in np.flatnonzero(2 * ones > len(h)).tolist()))


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp) with the fingerprint as a signed long."""
    def run(batches):
        for b in batches:
            fps = np.array([fingerprint(t, shingle) for t in b.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, fp long")


def trie_join(values: np.ndarray, root_bits: int, max_bits: int, chunk: int = 1 << 19):
    """Index pairs (i, j) of sorted distinct uint64 ``values`` that share the first ``root_bits`` bits and differ in at
    most ``max_bits`` bits; yields arrays.  Frontiers larger than ``chunk`` are cut and finished one after another."""
    v = values
    heads = v >> np.uint64(64 - root_bits)
    cut = np.flatnonzero(np.concatenate(([True], heads[1:] != heads[:-1], [True])))
    lo, hi = cut[:-1], cut[1:]
    big = hi - lo > 1
    lo, hi = lo[big], hi[big]
    stack = [(root_bits, lo, hi, lo, hi, np.zeros(len(lo), np.int8))]
    while stack:
        depth, al, ah, bl, bh, err = stack.pop()
        if not len(al):
            continue
        if len(al) > chunk:
            for s in range(0, len(al), chunk):
                stack.append((depth, *(x[s:s + chunk] for x in (al, ah, bl, bh, err))))
            continue
        single = (ah - al == 1) & (bh - bl == 1)
        if single.any():
            i, j = al[single], bl[single]
            near = (i != j) & (np.bitwise_count(v[i] ^ v[j]) <= max_bits)
            yield i[near], j[near]
            al, ah, bl, bh, err = (x[~single] for x in (al, ah, bl, bh, err))
        if not len(al) or depth == 64:
            continue
        bit = np.uint64(1) << np.uint64(63 - depth)

        def middle(lo_):
            return np.searchsorted(v, (v[lo_] & ~(bit | (bit - np.uint64(1)))) | bit)

        am, bm = np.clip(middle(al), al, ah), np.clip(middle(bl), bl, bh)
        same = al == bl
        # (child of a, child of b, added error); a node paired with itself has one crossing pair, not two
        moves = [(al, am, bl, bm, 0, None), (am, ah, bm, bh, 0, None), (al, am, bm, bh, 1, None), (am, ah, bl, bm, 1, ~same)]
        nxt = []
        for x0, x1, y0, y1, add, only in moves:
            keep = (x1 > x0) & (y1 > y0) & (err + add <= max_bits)
            if only is not None:
                keep &= only
            keep &= ~((x0 == y0) & (x1 - x0 == 1))
            nxt.append((x0[keep], x1[keep], y0[keep], y1[keep], (err[keep] + add).astype(np.int8)))
        stack.append((depth + 1, *(np.concatenate(x) for x in zip(*nxt))))


def link_fingerprints(fps: DataFrame, max_bits: int = 3, root_rows: int = 50_000, bucket_rows: int = 100_000) -> DataFrame:
    """(a, b): a spanning forest of the links in each task; its components are those of all links."""
    blocks = max_bits + 1
    width = [64 // blocks + (i < 64 % blocks) for i in range(blocks)]
    shift = np.concatenate(([0], np.cumsum(width)[:-1])).tolist()
    rotated = [F.lit(0).cast("long") + (F.shiftleft("fp", s).bitwiseOR(F.shiftrightunsigned("fp", 64 - s)) if s else F.col("fp"))
               for s in shift]
    rows = fps.select(F.explode(F.array(*[F.struct(F.lit(i).alias("r"), x.alias("x"),
                                                   F.shiftrightunsigned(x, 64 - width[i]).alias("root"),
                                                   F.shiftrightunsigned(x, 64 - width[i] - SPLIT_BITS).bitwiseAND(F.lit((1 << SPLIT_BITS) - 1)).alias("sub"))
                                          for i, x in enumerate(rotated)])).alias("e")).select("e.*")
    hot = rows.groupBy("r", "root").count().where(F.col("count") > root_rows).select("r", "root", F.lit(True).alias("hot"))
    near = F.array(*[F.lit(x) for x in range(1 << SPLIT_BITS) if x.bit_count() <= max_bits])
    n = fps.count()
    buckets = max(1, -(-n * blocks // bucket_rows))
    deal = (rows.join(hot, ["r", "root"], "left")
            .withColumn("flip", F.explode(F.when(F.col("hot"), near).otherwise(F.array(F.lit(0)))))
            .withColumn("pair", F.when(F.col("hot"), F.least("sub", F.col("sub").bitwiseXOR(F.col("flip"))) * (1 << SPLIT_BITS)
                                       + F.greatest("sub", F.col("sub").bitwiseXOR(F.col("flip")))).otherwise(F.lit(-1)))
            .select("r", F.when(F.col("hot"), F.xxhash64("root", "pair")).otherwise(F.pmod(F.xxhash64("root"), F.lit(buckets))).alias("bucket"), "x"))

    def join(key, pdf: pd.DataFrame) -> pd.DataFrame:
        r = int(key[0])
        v = np.unique(pdf["x"].to_numpy().view(np.uint64))
        p = np.arange(len(v))
        for i, j in trie_join(v, width[r], max_bits):
            p = local_components(len(v), i, j, p)
        s = shift[r]
        back = ((v >> np.uint64(s)) | (v << np.uint64(64 - s)) if s else v).view(np.int64)
        linked = np.flatnonzero(p != np.arange(len(v)))
        return pd.DataFrame({"a": back[linked], "b": back[p[linked]]})

    return deal.groupBy("r", "bucket").applyInPandas(join, "a long, b long")


def simhash_dedup(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable)."""
    fps = materialize(fingerprints(docs, shingle), "simhash-fp")
    distinct = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    comp = connected_components(link_fingerprints(distinct.select("fp"), max_bits), "simhash")
    label = (distinct.join(comp.withColumnRenamed("id", "fp"), "fp", "left")
             .select("fp", "first", F.coalesce("root", "fp").alias("root")))
    smallest = label.groupBy("root").agg(F.min("first").alias("component_id"))
    label = materialize(label.join(smallest, "root").select("fp", "component_id"), "simhash-label")
    return fps.join(label, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_representatives(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest doc_id (of rows that repeat it, one).
    Rows without a doc_id cannot be told apart and stay."""
    of, copies = fresh_name(docs, "representative"), fresh_name(docs, "copies")
    groups = simhash_dedup(docs.select("doc_id", "text"), shingle, max_bits)
    keep = groups.where("doc_id = component_id").groupBy(F.col("doc_id").alias(of)).agg(F.count("*").alias(copies))
    kept = docs.join(keep, F.col("doc_id").cast("long") == F.col(of))
    once = kept.where(F.col(copies) == 1).select(*docs.columns)
    repeated = kept.where(F.col(copies) > 1).select(*docs.columns).dropDuplicates(["doc_id"])
    return once.unionByName(repeated).unionByName(docs.where("doc_id IS NULL"))
