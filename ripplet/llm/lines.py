"""Fuzzy line dedup: MinHash of character shingles, banding, exact Jaccard verification, distributed union-find.

A line is a piece of the text between line feeds; lines of white space only are never compared nor removed.  Equal lines
are one vertex (named by their MD5).  ``bands`` x ``rows`` MinHash values of the line's ``shingle``-character shingles
(a shorter line is one shingle) give the bucket keys; with the defaults a pair at the threshold meets in some bucket
with probability 0.997, closer pairs more surely.  Lines that meet are compared exactly (Jaccard of the shingle sets of
their code points).  A bucket is not expanded into all pairs: its members are first compared with the bucket's leader, its
most frequent line (of near copies, usually the original).  After the union-find, only members outside the leader's
component are compared with members of other components, and only where exact bounds allow a link, so no link between
different components of a bucket goes untested.  That happens inside the bucket's task, which joins components as it goes
and sends at most one edge for each, so its output grows with the lines, not with their pairs.

Of each component the first line stays (smallest doc_id, then line number; a null doc_id comes last); rows that repeat
a doc_id are one document, whose equal lines of equal number stay or go together.  Null and empty texts have no lines.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ripplet.llm.common import BitTable, connected_components, fresh_name
from ripplet.llm.words import mix
from ripplet.session import materialize

CHUNK_CHARS = 1 << 20
SCAN_CHARS = 1 << 22
BLOCK_CHARS = 1 << 15
FILTER_BITS = 26
PROFILE_BITS = 1024
PACK_ROWS = 20_000
PACK_WORDS = 1 << 20
_BASE = 0x9E3779B97F4A7C15


def _families(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    return rng.integers(0, 1 << 31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1), rng.integers(0, 1 << 32, n, dtype=np.uint32)


def _blocks(lines: list[str]):
    """Consecutive lines of about BLOCK_CHARS: arrays of that size stay in a core's cache."""
    at = 0
    while at < len(lines):
        stop, chars = at, 0
        while stop < len(lines) and chars < BLOCK_CHARS:
            chars += len(lines[stop])
            stop += 1
        yield at, lines[at:stop]
        at = stop


def _hashes(cps: np.ndarray, shingle: int, n: int) -> np.ndarray:
    """Polynomial hash of the ``shingle`` code points from each of the first ``n`` places; ``cps`` holds as many more."""
    h = np.zeros(n, np.uint64)
    for j in range(shingle):
        np.multiply(h, np.uint64(_BASE), out=h)
        np.add(h, cps[j:j + n], out=h)
    return h


def _code_points(lines: list[str], more: int) -> np.ndarray:
    cps = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.zeros(len(cps) + more, np.uint64)
    np.add(cps, np.uint64(1), out=out[:len(cps)], casting="unsafe")
    return out


def signatures(lines: list[str], shingle: int, n: int) -> np.ndarray:
    """(len(lines), n) MinHash values of non-empty lines."""
    out = np.empty((len(lines), n), np.uint32)
    a, b = _families(n)
    for at, part in _blocks(lines):
        size = np.fromiter(map(len, part), np.int64, len(part))
        total = int(size.sum())
        h = _hashes(_code_points(part, shingle), shingle, total)  # shingles beyond their line's end are cut below
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
        h = (h >> np.uint64(32)).astype(np.uint32)
        start = np.cumsum(size) - size
        count = np.maximum(size - shingle + 1, 1)
        for i in np.flatnonzero(size < shingle).tolist():  # one shingle: the whole line
            h[start[i]] = int.from_bytes(hashlib.md5(part[i].encode("utf-8", "surrogatepass")).digest()[:4], "little")
        h = h[np.arange(total) < np.repeat(start + count, size)]
        cut = np.cumsum(count) - count
        v = np.empty_like(h)
        for k in range(n):
            np.multiply(h, a[k], out=v)
            np.add(v, b[k], out=v)
            out[at:at + len(part), k] = np.minimum.reduceat(v, cut)
    return out


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(lines, bands) 64-bit bucket keys."""
    s = sig.reshape(len(sig), bands, rows).astype(np.uint64)
    h = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(_BASE), s.shape[:2]).copy()
    for k in range(rows):
        h = (h ^ s[:, :, k]) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
    return h.view(np.int64)


def _key(line: str) -> bytes:
    return hashlib.md5(line.encode("utf-8", "surrogatepass")).digest()


def _scan(docs: DataFrame, shingle: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, line_no, key, bands): every line that counts; ``bands`` only at its first place in a chunk."""
    def run(batches):
        for b in batches:
            i = 0
            while i < len(b):
                fresh, ids, numbers, keys, first = {}, [], [], [], []
                chars = 0
                while i < len(b) and chars < SCAN_CHARS:
                    text, doc = b.column(1)[i].as_py() or "", b.column(0)[i].as_py()
                    chars += len(text)
                    for no, line in enumerate(text.split("\n")):
                        if not line or line.isspace():
                            continue
                        known = fresh.get(line)
                        first.append(known is None)
                        if known is None:
                            known = fresh[line] = _key(line)
                        ids.append(doc)
                        numbers.append(no)
                        keys.append(known)
                    i += 1
                if not ids:
                    continue
                blob = band_keys(signatures(list(fresh), shingle, bands * rows), bands, rows)
                mask = np.array(first)
                at = np.where(mask, np.cumsum(mask) - 1, 0)
                values = pa.array(blob[at[mask]].ravel())
                offsets = pa.array(np.concatenate(([0], np.cumsum(mask) * bands)).astype(np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(numbers, pa.int32()), pa.array(keys, pa.binary()),
                                                  pa.ListArray.from_arrays(offsets, values)], ["doc_id", "line_no", "key", "bands"])
    return docs.mapInArrow(run, "doc_id long, line_no int, key binary, bands array<long>")


def _key_filter(keys: DataFrame) -> BitTable:
    at = F.conv(F.hex(F.substring("key", 1, 4)), 16, 10).cast("long").bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    return BitTable.of(keys.select(at.alias("at")), FILTER_BITS)


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(key, line) of the lines named in ``wanted`` (key), and of some others: a second scan that a bit table thins out."""
    bits = _key_filter(wanted).table

    def run(batches):
        table = bits.value
        for b in batches:
            found = {}
            for text in b.column(0).to_pylist():
                for line in set((text or "").split("\n")):
                    if line and line not in found:
                        key = _key(line)
                        at = int.from_bytes(key[:4], "big") & ((1 << FILTER_BITS) - 1)
                        if table[at >> 5] >> (at & 31) & 1:
                            found[line] = key
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(list(found.values()), pa.binary()), pa.array(list(found), pa.string())], ["key", "line"])
    lines = docs.select("text").mapInArrow(run, "key binary, line string")
    return lines.distinct()  # equal keys are equal lines


_PACKED = 511  # code points below this fit 9 bits with 0 to spare; seven of them are one exact 64-bit code


class LineSets:
    """Exact shingle sets of distinct lines.  Where all code points are small, a shingle packs into one word and a set is a
    sorted array; sets of other lines are built of strings when they are compared.  ``size`` and ``bits`` (a bitmap of
    shingle hashes, the same for both kinds) bound similarities from above."""

    def __init__(self, lines: list[str], shingle: int, bits: bool = False):
        self.lines, self.shingle, self.strings = lines, shingle, {}
        self.codes: list[np.ndarray | None] = []
        self.size = np.zeros(len(lines))
        self.bits = np.zeros((len(lines), PROFILE_BITS // 64), np.uint64) if bits else None
        for at, part in _blocks(lines):
            self._fill(part, at)

    def _fill(self, part: list[str], at: int) -> None:
        k, size = self.shingle, np.array([len(x) for x in part], np.int64)
        cps = _code_points(part, k)
        start = np.cumsum(size) - size
        code = np.zeros(len(cps) - k, np.uint64)
        for j in range(k):
            code = (code << np.uint64(9)) | cps[j:len(cps) - k + j]
        packs = k <= 7
        for i, (s, n) in enumerate(zip(start.tolist(), size.tolist())):
            own = cps[s:s + n]
            if not packs or n < k or int(own.max()) > _PACKED:  # a short line is one shingle of its own length
                self.codes.append(None)
                self.size[at + i] = len({part[i][x:x + k] for x in range(max(1, n - k + 1))})
                continue
            u = np.sort(code[s:s + n - k + 1])
            u = u[np.append(True, u[1:] != u[:-1])]
            self.codes.append(u)
            self.size[at + i] = len(u)
        if self.bits is not None:
            h = _hashes(cps, k, len(code))
            count = np.maximum(size - k + 1, 1)
            owner = np.repeat(np.arange(len(part)), count)
            place = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(start, count)
            full = size[owner] >= k
            rows = np.zeros((len(part), PROFILE_BITS), bool)
            rows[owner[full], (mix(h[place[full]]) >> np.uint64(54)).astype(np.int64) % PROFILE_BITS] = True
            for i in np.flatnonzero(size < k).tolist():
                rows[i, hash_bit(part[i])] = True
            self.bits[at:at + len(part)] = np.packbits(rows, axis=1).view(np.uint64)

    def _strings(self, i: int) -> set[str]:
        got = self.strings.get(i)
        if got is None:
            if len(self.strings) > 500:
                self.strings.clear()
            x = self.lines[i]
            got = self.strings[i] = {x[j:j + self.shingle] for j in range(max(1, len(x) - self.shingle + 1))}
        return got

    def jaccard(self, i: int, j: int) -> float:
        a, b = self.codes[i], self.codes[j]
        if a is None or b is None:
            x, y = self._strings(i), self._strings(j)
            both = len(x & y)
            return both / (len(x) + len(y) - both)
        c = np.concatenate((a, b))
        c.sort()
        both = int(np.count_nonzero(c[1:] == c[:-1]))
        return both / (len(c) - both)


def hash_bit(line: str) -> int:
    return hashlib.md5(line.encode("utf-8", "surrogatepass")).digest()[0]


def jaccard(a: str, b: str, shingle: int) -> float:
    """Exact Jaccard similarity of the shingle sets of two lines."""
    return LineSets([a, b], shingle).jaccard(0, 1)


def _similarities(pairs: DataFrame, texts: DataFrame, shingle: int) -> DataFrame:
    """The pairs (a, b) with their exact similarity."""
    def run(batches):
        for b in batches:
            left, right, at = b.column(2).to_pylist(), b.column(3).to_pylist(), 0
            while at < len(left):
                number: dict[str, int] = {}
                pair, chars = [], 0
                while at + len(pair) < len(left) and chars < CHUNK_CHARS:
                    x, y = left[at + len(pair)], right[at + len(pair)]
                    chars += len(x) + len(y)
                    pair.append((number.setdefault(x, len(number)), number.setdefault(y, len(number))))
                sets = LineSets(list(number), shingle)
                sim = pa.array([sets.jaccard(i, j) for i, j in pair], pa.float64())
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(pair)), b.column(1).slice(at, len(pair)), sim], ["a", "b", "sim"])
                at += len(pair)
    full = (pairs.join(texts.select(F.col("key").alias("a"), F.col("line").alias("la")), "a")
            .join(texts.select(F.col("key").alias("b"), F.col("line").alias("lb")), "b").select("a", "b", "la", "lb"))
    return full.mapInArrow(run, "a binary, b binary, sim double")


def _cross_links(label: DataFrame, texts: DataFrame, threshold: float, shingle: int, block: int = 1000) -> DataFrame:
    """(a, b): links between components that meet in a bucket, as a spanning forest of component roots for each cell.

    Each bucket is dealt out in cells of about ``block`` strays and ten times as many members.  A pair of a stray and a
    member of another component is first held against bounds that never lose a link: 1 - Jaccard is a metric, so the
    distances to the leader must not differ by more than 1 - threshold; and a bit of one line's bitmap that the other's
    lacks is a shingle the other lacks, which bounds the similarity from above.  What passes is compared exactly in the
    task, unless its components were joined there before.  No pair leaves the task: at most one edge a root does."""
    busy = label.groupBy("h").agg(F.count("*").alias("n"), F.sum(F.col("stray").cast("int")).alias("ns")).where("ns > 0")
    rows = label.join(busy, "h").withColumns({"cells": F.ceil(F.col("ns") / block), "shares": F.ceil(F.col("n") / (10 * block))})
    rows = rows.join(texts, "key").select("h", "key", "root", "stray", "sim", "line", "n", "ns", "cells", "shares")
    # a cell is drawn by a hash of the key, so no bucket is sorted or numbered as one group
    sb, mb = F.pmod(F.xxhash64("key", F.lit(1)), F.col("cells")), F.pmod(F.xxhash64("key", F.lit(2)), F.col("shares"))
    strays = rows.where("stray").select("h", sb.alias("sb"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)).alias("mb"),
                                        "key", "root", "stray", "sim", "line", "n", "ns")
    members = rows.select("h", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cells") - 1)).alias("sb"), mb.alias("mb"),
                          "key", "root", "stray", "sim", "line", "n", "ns")

    # buckets of one cell share a task's group by a hash; the cells of a large bucket stand alone
    packs = max(1, -(-label.count() // PACK_ROWS))

    def named(df):
        whole = (F.col("ns") <= block) & (F.col("n") <= 10 * block)
        return df.withColumn("cell", F.when(whole, F.pmod(F.xxhash64("h"), F.lit(packs))).otherwise(F.xxhash64("h", "sb", "mb")))

    def compare(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"a": [], "b": []})
        left, right = left.sort_values("h", kind="stable"), right.sort_values("h", kind="stable")
        home = right["h"].to_numpy()
        begin, finish = (np.searchsorted(home, left["h"].to_numpy(), side=x).tolist() for x in ("left", "right"))
        number: dict[bytes, int] = {}
        texts: list[str] = []
        at_line = []
        for side in (left, right):
            for k, t in zip(side["key"], side["line"]):
                if k not in number:
                    number[k] = len(texts)
                    texts.append(t)
            at_line.append(np.array([number[k] for k in side["key"]]))
        sets = LineSets(texts, shingle, bits=True)
        bits, size = sets.bits, sets.size
        ln, rn = at_line
        roots = sorted(set(left["root"]) | set(right["root"]))
        place = {r: i for i, r in enumerate(roots)}
        lr, rr = (np.array([place[r] for r in side["root"]]) for side in (left, right))
        lk, rk = left["key"].to_numpy(), right["key"].to_numpy()
        lsim, rsim, also = left["sim"].to_numpy(float), right["sim"].to_numpy(float), right["stray"].to_numpy(bool)
        group = np.arange(len(roots))  # components joined in this cell

        for i in range(len(left)):
            at = np.arange(begin[i], finish[i])  # the members of the stray's bucket
            mine, other = size[ln[i]], size[rn[at]]
            near = at[(np.abs(rsim[at] - lsim[i]) <= 1 - threshold + 1e-9) & (np.minimum(other, mine) >= threshold * np.maximum(other, mine) - 1e-9)
                      & (group[rr[at]] != group[lr[i]])]
            if not len(near):
                continue
            lb, rb, other = bits[ln[i]], bits[rn[near]], size[rn[near]]
            common = np.minimum(mine - np.bitwise_count(lb & ~rb).sum(axis=1), other - np.bitwise_count(rb & ~lb).sum(axis=1))
            for j in near[common >= threshold * (mine + other - common) - 1e-9].tolist():
                u, v = group[lr[i]], group[rr[j]]
                if u != v and (not also[j] or lk[i] > rk[j]) and sets.jaccard(ln[i], rn[j]) >= threshold:
                    group[group == max(u, v)] = min(u, v)
        moved = np.flatnonzero(group != np.arange(len(roots)))
        return pd.DataFrame({"a": [roots[x] for x in moved.tolist()], "b": [roots[x] for x in group[moved].tolist()]})
    strays, members = named(strays).drop("sb", "mb", "n", "ns"), named(members).drop("sb", "mb", "n", "ns")
    members = members.toDF(*members.columns)  # columns of their own, not those that the strays have
    return strays.groupBy("cell").cogroup(members.groupBy("cell")).applyInPandas(compare, "a binary, b binary")


def _several(lines: DataFrame) -> BitTable:
    """Bit table of the bucket keys (by their leading bits) that several lines have, from (key, bands).

    A task packs the keys of many lines, each with 24 bits of its line's hash, as sorted distinct words by their leading
    bits; one task for each part finds the keys with several lines.  Equal bits of unequal keys only let more pass."""
    total = lines.count()
    part_bits = min(FILTER_BITS - 3, max(4, (total // 200_000).bit_length()))  # parts of a few million words at most
    share = FILTER_BITS - part_bits

    def packed(words):
        v = np.unique(np.concatenate(words))
        part = (v >> np.uint64(64 - part_bits)).astype(np.int32)
        cut = np.flatnonzero(np.diff(part, prepend=-1))
        blobs = [np.diff(x, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes() for x in np.split(v, cut[1:])]
        return pa.RecordBatch.from_arrays([pa.array(part[cut]), pa.array([len(x) for x in blobs], pa.int32()),
                                           pa.array([pa.compress(x, "zstd", asbytes=True) for x in blobs], pa.binary())], ["part", "size", "blob"])

    def run(batches):
        words, n = [], 0
        for b in batches:
            h = b.column(1).flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            line = np.repeat(b.column(0).to_numpy(zero_copy_only=False).view(np.uint64), b.column(1).value_lengths().to_numpy(zero_copy_only=False))
            words.append(h >> np.uint64(24) << np.uint64(24) | line >> np.uint64(40))
            n += len(h)
            if n >= PACK_WORDS:
                yield packed(words)
                words, n = [], 0
        if n:
            yield packed(words)

    def several(key, pdf: pd.DataFrame) -> pd.DataFrame:
        planes = (np.frombuffer(pa.decompress(b, n, "zstd", asbytes=True), np.uint8).reshape(8, -1) for b, n in zip(pdf["blob"], pdf["size"].tolist()))
        v = np.unique(np.concatenate([np.cumsum(np.ascontiguousarray(x.T).view(np.uint64).ravel(), dtype=np.uint64) for x in planes])) >> np.uint64(24)
        v = v[1:][v[1:] == v[:-1]] & np.uint64((1 << (40 - part_bits)) - 1)
        bits = np.zeros(1 << share, np.uint8)
        bits[(v >> np.uint64(40 - FILTER_BITS)).astype(np.int64)] = 1
        return pd.DataFrame({"part": [int(key[0])], "segment": [np.packbits(bits, bitorder="little").tobytes()]})
    words = lines.select(F.xxhash64("key").alias("line"), "bands").mapInArrow(run, "part int, size int, blob binary")
    return BitTable.of_segments(words.groupBy("part").applyInPandas(several, "part int, segment binary"), FILTER_BITS)


def _buckets(lines: DataFrame) -> DataFrame:
    """(h, key, leader) of the buckets with several lines, from (key, bands) once for each chunk that holds the line.  All
    aggregates are partial before they meet, and the leader is joined back, so no bucket is one task's group."""
    lines = lines.where("bands IS NOT NULL AND size(bands) > 0").select("key", "bands")
    # most buckets hold one line only: a bit table of the others thins out the second scan
    bits = _several(lines).table

    def run(batches):
        for b in batches:
            h = b.column(1).flatten().to_numpy(zero_copy_only=False)
            owner = np.repeat(np.arange(len(b)), b.column(1).value_lengths().to_numpy(zero_copy_only=False))
            ok = BitTable.test(bits.value, (h.view(np.uint64) >> np.uint64(64 - FILTER_BITS)).astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(h[ok]), b.column(0).take(pa.array(owner[ok])).cast(pa.binary())], ["h", "key"])
    counted = lines.mapInArrow(run, "h long, key binary").groupBy("h", "key").agg(F.count("*").alias("n"))
    members = materialize(counted, "line-members")
    leaders = members.groupBy("h").agg(F.max(F.struct("n", "key"))["key"].alias("leader"), F.count("*").alias("lines")).where("lines > 1").drop("lines")
    return members.join(leaders, "h").select("h", "key", "leader")


def line_components(docs: DataFrame, shingle: int = 7, bands: int = 11, rows: int = 4, threshold: float = 0.8):
    """(occurrences (doc_id, line_no, key), components (id, root) of the keys that have a link)."""
    rows_of = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    lines = materialize(_scan(rows_of, shingle, bands, rows), "lines")
    shared = materialize(_buckets(lines), "line-buckets")
    texts = materialize(_texts(rows_of, shared.select("key")), "line-texts")
    stars = shared.where("key <> leader").select(F.col("key").alias("a"), F.col("leader").alias("b")).distinct()
    sims = materialize(_similarities(stars, texts, shingle), "line-links")
    links = sims.where(F.col("sim") >= threshold).select("a", "b")
    comp = connected_components(links, "lines")
    label = shared.join(comp.withColumnRenamed("id", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    main = label.where("key = leader").select("h", F.col("root").alias("main"))
    named = sims.select(F.col("a").alias("key"), F.col("b").alias("leader"), "sim")
    label = materialize(label.where("key <> leader").join(main, "h").join(named, ["key", "leader"])
                        .withColumn("stray", F.expr("root <> main")), "line-labels")
    more = materialize(_cross_links(label, texts, threshold, shingle), "line-links")
    if more.isEmpty():
        return lines.select("doc_id", "line_no", "key"), comp
    return lines.select("doc_id", "line_no", "key"), connected_components(links.union(more), "lines")


def removed_lines(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, removed: sorted line numbers) of the documents that lose lines."""
    lines, comp = line_components(docs, **options)
    # (doc_id, line_no) as one number, which a hash aggregate takes; beyond all of them where the doc_id is null
    place = F.coalesce(F.col("doc_id").cast("decimal(38,0)") * (1 << 32), F.lit("1" + "0" * 37).cast("decimal(38,0)")) + F.col("line_no")
    lines = lines.withColumn("place", place.cast("decimal(38,0)"))
    # most lines stand once and have no link: what is left of the keys is small
    linked = comp.select(F.col("id").alias("key"), F.lit(None).cast("decimal(38,0)").alias("place"), F.lit(0).alias("one"), F.lit(1).alias("linked"))
    keys = (lines.select("key", "place", F.lit(1).alias("one"), F.lit(0).alias("linked")).unionByName(linked).groupBy("key")
            .agg(F.min("place").alias("first"), F.sum("one").alias("n"), F.max("linked").alias("linked")).where("n > 1 OR linked = 1").drop("linked"))
    keys = keys.join(comp.withColumnRenamed("id", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    keys = materialize(keys, "line-roots")
    first = keys.groupBy("root").agg(F.min("first").alias("first"), F.sum("n").alias("n")).where("n > 1").drop("n")
    named = materialize(keys.select("key", "root").join(first, "root").select("key", "first"), "line-firsts")
    bits = BitTable.of(named.select(F.shiftrightunsigned(F.xxhash64("key"), 64 - FILTER_BITS).alias("at")), FILTER_BITS).table

    @F.pandas_udf("boolean")
    def may_go(hashes: pd.Series) -> pd.Series:
        return pd.Series(BitTable.test(bits.value, hashes.to_numpy(np.int64)))
    gone = lines.where(may_go(F.shiftrightunsigned(F.xxhash64("key"), 64 - FILTER_BITS))).join(named, "key").where("place <> first")
    return gone.groupBy("doc_id").agg(F.array_sort(F.collect_set("line_no")).alias("removed"))


def dedup_lines(docs: DataFrame, **options) -> DataFrame:
    """One row per input row: doc_id, n_lines, n_removed, removed (sorted line numbers from 0)."""
    n = F.when(F.length("text") > 0, F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).otherwise(0)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).select("doc_id", n.cast("int").alias("n_lines"))
    gone = removed_lines(docs, **options).withColumnRenamed("doc_id", "d")
    removed = F.coalesce("removed", F.expr("CAST(array() AS array<int>)"))
    return (base.join(gone, F.col("doc_id").eqNullSafe(F.col("d")), "left")
            .select("doc_id", "n_lines", F.size(removed).alias("n_removed"), removed.alias("removed")))


def keep_first_lines(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without the removed lines.  A document that loses all it had (white space apart) goes; one that had
    nothing, or loses nothing, stays as it is."""
    of, cut, was = (fresh_name(docs, x) for x in ("removed_of", "removed_lines", "was_cut"))
    gone = removed_lines(docs, **options).select(F.col("doc_id").alias(of), F.col("removed").alias(cut))
    pieces = F.transform(F.split("text", "\n", -1), lambda x, i: F.struct(x.alias("x"), i.alias("i")))
    kept = F.array_join(F.transform(F.filter(pieces, lambda s: ~F.array_contains(cut, s["i"])), lambda s: s["x"]), "\n")
    columns = [F.when(F.col(cut).isNull(), F.col("text")).otherwise(kept).alias("text") if c == "text" else F.col(c) for c in docs.columns]
    joined = docs.join(gone, F.col("doc_id").cast("long").eqNullSafe(F.col(of)), "left")
    return (joined.select(*columns, F.col(cut).isNotNull().alias(was))
            .where(~F.col(was) | F.rlike("text", F.lit(r"\S"))).drop(was))
