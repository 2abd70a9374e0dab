"""Benchmark decontamination: prefix-filtered join of item windows with documents.

Words: A-Z lower-cased, ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``.  A window is ``window`` consecutive words of an item (an
item of fewer words, but not none, is one window).  Shingles are runs of three words (the whole of a shorter window),
ordered by rarity over all documents.  A document holds a window only if it holds each of its shingles, so at full
containment one prefix token is enough: the window's rarest shingle.  A document shingle that is some window's prefix
token gives a candidate start; it must leave room for the window inside the document (length and positional bounds),
and the words of the window are then compared one by one.

Items go to the tasks in blocks of bounded size, each against all documents; one block is the rule, and more blocks are
merged by row.  Null and empty texts have no words; null item texts have no windows; items of a null item_id hit words
but have no name to list; repeated items and rows count as
they stand (an item_id counts once per document); extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ripplet.llm.common import flat_text, row_chunks

GRAM = 3
BLOCK_BYTES = 16 << 20
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True
_BASE, _MIX = 0x9E3779B97F4A7C15, np.uint64(0xD6E8FEB86659FD93)
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 16)
        inverse = pow(_BASE, -1, 1 << 64)
        _POWERS[:] = [np.cumprod(np.full(size, b, np.uint64)) for b in (_BASE, inverse)]
    return _POWERS[0][:n], _POWERS[1][:n]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


class Words:
    """Word bounds, hashes and row numbers of a flat text."""

    def __init__(self, flat: np.ndarray, offsets: np.ndarray):
        flat = _LOWER[flat]
        inside = _WORD[flat]
        edge = inside.copy()
        edge[1:] &= ~inside[:-1]
        row_start = offsets[:-1][offsets[:-1] < len(flat)]
        edge[row_start] = inside[row_start]
        self.start = np.flatnonzero(edge)
        stop = ~inside
        ends = np.flatnonzero(np.concatenate((stop | edge, [True])))  # a word ends at a separator, a new word or the end
        self.end = ends[np.searchsorted(ends, self.start, side="right")] if len(self.start) else self.start
        self.flat = flat
        power, inverse = _powers(len(flat) + 1)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((flat.astype(np.uint64) + np.uint64(1)) * power[:-1])))
        self.hash = _mix((sums[self.end] - sums[self.start]) * inverse[self.start])
        self.first = np.searchsorted(self.start, offsets)  # first word of each row, and the end
        self.row = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))

    def grams(self, size: int) -> np.ndarray:
        n = len(self.hash) - size + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        out = self.hash[:n].copy()
        for k in range(1, size):
            out = _mix(out) + self.hash[k:n + k]
        return _mix(out)

    def text(self, i: int) -> bytes:
        return self.flat[self.start[i]:self.end[i]].tobytes()


class WindowIndex:
    """The windows of one block of items, keyed by their rarest shingle."""

    def __init__(self, items: list[tuple], window: int):
        self.ids = [i for i, _ in items]
        texts = pa.array([t or "" for _, t in items], pa.string())
        flat, offsets = flat_text(texts)
        w = Words(flat, offsets)
        count = np.diff(w.first)
        starts, lengths, owner = [], [], []
        for i, n in enumerate(count.tolist()):
            size = min(n, window)
            for k in range(n - size + 1 if n else 0):
                starts.append(w.first[i] + k)
                lengths.append(size)
                owner.append(i)
        self.owner, self.length = np.array(owner, np.int64), np.array(lengths, np.int64)
        self.words = [[w.text(s + k) for k in range(n)] for s, n in zip(starts, lengths)]
        self.hashes = np.zeros((len(starts), window), np.uint64)
        for i, (s, n) in enumerate(zip(starts, lengths)):
            self.hashes[i, :n] = w.hash[s:s + n]
        self.grams: list[tuple[int, np.ndarray, np.ndarray]] = []  # (shingle size, window numbers, their shingles by offset)
        sizes = np.minimum(self.length, GRAM)
        for g in np.unique(sizes).tolist():
            every = w.grams(g)
            for n in np.unique(self.length[sizes == g]).tolist():
                of = np.flatnonzero(self.length == n)
                at = np.array(starts, np.int64)[of][:, None] + np.arange(n - g + 1)
                self.grams.append((g, of, every[at]))

    def shingles(self) -> dict[int, np.ndarray]:
        out: dict[int, list] = {}
        for g, _, x in self.grams:
            out.setdefault(g, []).append(x.ravel())
        return {g: np.unique(np.concatenate(x)) for g, x in out.items()}

    def order(self, counts: dict[tuple[int, int], int]) -> None:
        """Choose each window's prefix token by the corpus counts (rarest; ties: smaller hash, then smaller offset)."""
        parts: dict[int, list] = {}
        for g, of, x in self.grams:
            uniq, inv = np.unique(x, return_inverse=True)
            rarity = np.array([counts.get((g, int(h)), 0) for h in uniq.astype(np.int64)], np.int64)
            rank = np.empty(len(uniq), np.int64)
            rank[np.lexsort((uniq, rarity))] = np.arange(len(uniq))
            best = rank[inv.reshape(x.shape)].argmin(axis=1)
            parts.setdefault(g, []).append((x[np.arange(len(of)), best], of, best))
        self.prefix = {}
        for g, found in parts.items():
            key, of, at = (np.concatenate(c) for c in zip(*found))
            o = np.argsort(key, kind="stable")
            self.prefix[g] = (Lookup(key[o]), of[o], at[o])
        del self.grams

    def match(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(first word, window number) of every occurrence."""
        at_word, of_window = [], []
        for g, (lookup, of, offset) in self.prefix.items():
            found = words.grams(g)
            i, lo, hi = lookup.ranges(found)
            n = hi - lo
            pick = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
            start = np.repeat(i, n) - offset[pick]
            win = of[pick]
            gram_row = words.row[np.repeat(i, n)]
            fits = (start >= words.first[gram_row]) & (start + self.length[win] <= words.first[gram_row + 1])
            start, win = start[fits], win[fits]
            for k in range(self.hashes.shape[1]):
                beyond = k >= self.length[win]
                same = beyond | (words.hash[np.minimum(start + k, len(words.hash) - 1)] == self.hashes[win, k])
                start, win = start[same], win[same]
            exact = [all(words.text(s + k) == x for k, x in enumerate(self.words[v])) for s, v in zip(start.tolist(), win.tolist())]
            exact = np.array(exact, bool)
            at_word.append(start[exact])
            of_window.append(win[exact])
        if not at_word:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(at_word), np.concatenate(of_window)


class Lookup:
    """Sorted keys behind a bit table, so that most probes end after one gather."""

    BITS = 22

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.table = np.zeros(1 << self.BITS, bool)
        self.table[keys >> np.uint64(64 - self.BITS)] = True

    def ranges(self, probes: np.ndarray):
        """(probe number, from, to): the equal keys of each probe that has some."""
        i = np.flatnonzero(self.table[probes >> np.uint64(64 - self.BITS)])
        lo, hi = np.searchsorted(self.keys, probes[i]), np.searchsorted(self.keys, probes[i], side="right")
        has = hi > lo
        return i[has], lo[has], hi[has]


def _in_row(words: Words, size: int) -> np.ndarray:
    n = len(words.hash) - size + 1
    return words.row[:max(n, 0)] == words.row[size - 1:] if n > 0 else np.zeros(0, bool)


def _rarity(docs: DataFrame, shingles) -> dict[tuple[int, int], int]:
    """How often each shingle of the block occurs over all documents."""
    def run(batches):
        for b in batches:
            flat, offsets = flat_text(b.column(1))
            for i, j in row_chunks(offsets):
                w = Words(flat[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                for g, keys in shingles.value.items():
                    lookup = Lookup(keys)
                    found = w.grams(g)[_in_row(w, g)]
                    _, lo, _ = lookup.ranges(found)
                    n = np.bincount(lo, minlength=len(keys))
                    has = np.flatnonzero(n)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(has), g, np.int32)), pa.array(keys[has].view(np.int64)), pa.array(n[has])], ["g", "h", "n"])
    found = docs.mapInArrow(run, "g int, h long, n long").groupBy("g", "h").agg(F.sum("n").alias("n")).collect()
    return {(r.g, r.h): r.n for r in found}


def _blocks(items: DataFrame, block_bytes: int):
    """One function per block of at most about ``block_bytes`` of item text, which collects it: (item_id, text) rows."""
    items = items.select(F.col("item_id").cast("string"), F.col("text").cast("string"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    for k in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        yield lambda part=part: [tuple(r) for r in part.collect()]


def _shared_index(rows: DataFrame, items: list[tuple], window: int):
    """Broadcast index of a block, its prefix tokens chosen by the counts over all rows."""
    index = WindowIndex(items, window)
    sc = rows.sparkSession.sparkContext
    index.order(_rarity(rows.select("doc_id", "text"), sc.broadcast(index.shingles())) if index.grams else {})
    return sc.broadcast(index)


def keep_clean(docs: DataFrame, items: DataFrame, window: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without the rows that hold a window of an item."""
    at = docs.columns.index("text")
    for part in _blocks(items, block_bytes):
        rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
        shared = _shared_index(rows, part(), window)

        def run(batches, shared=shared):
            for b in batches:
                flat, offsets = flat_text(b.column(at))
                clean = np.ones(len(b), bool)
                for i, j in row_chunks(offsets):
                    w = Words(flat[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                    start, _ = shared.value.match(w)
                    clean[i + w.row[start]] = False
                yield b.filter(pa.array(clean))
        docs = docs.mapInArrow(run, docs.schema)
    return docs


def find_windows(docs: DataFrame, items: DataFrame, window: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, hits (merged word spans [start, stop)), items (sorted item_ids as strings)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    parts = list(_blocks(items, block_bytes))
    if len(parts) > 1:  # a row needs a name of its own to be merged over the blocks
        from ripplet.session import materialize
        rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "decontam-rows")
    out = None
    for part in parts:
        found = _match_block(rows, part(), window)
        out = found if out is None else out.unionByName(found)
    if len(parts) > 1:
        merged = F.aggregate(F.array_sort(F.flatten(F.collect_list("hits"))), F.expr("CAST(array() AS array<struct<start:int,stop:int>>)"),
                             lambda acc, x: F.when((F.size(acc) > 0) & (F.element_at(acc, -1)["stop"] >= x["start"]),
                                                   F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))),
                                                            F.array(F.struct(F.element_at(acc, -1)["start"].alias("start"),
                                                                             F.greatest(F.element_at(acc, -1)["stop"], x["stop"]).alias("stop")))))
                             .otherwise(F.concat(acc, F.array(x))))
        out = (out.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), merged.alias("hits"),
                                      F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")).drop("row"))
    return out


def _match_block(rows: DataFrame, items: list[tuple], window: int) -> DataFrame:
    shared = _shared_index(rows, items, window)
    span = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
    extra = "row" in rows.columns

    def run(batches):
        ix = shared.value
        for b in batches:
            flat, offsets = flat_text(b.column(1))
            for i, j in row_chunks(offsets):
                w = Words(flat[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                start, win = ix.match(w)
                edge = np.zeros(len(w.hash) + 1, np.int64)
                np.add.at(edge, start, 1)
                np.add.at(edge, start + ix.length[win], -1)
                hit = np.cumsum(edge[:-1]) > 0
                hits: list[list] = [[] for _ in range(j - i)]
                names: list[set] = [set() for _ in range(j - i)]
                for r, v in set(zip(w.row[start].tolist(), ix.owner[win].tolist())):
                    if ix.ids[v] is not None:
                        names[r].add(ix.ids[v])
                turn = hit.copy()
                turn[1:] &= ~hit[:-1] | (w.row[1:] != w.row[:-1])
                first = np.flatnonzero(turn)
                turn = hit.copy()
                turn[:-1] &= ~hit[1:] | (w.row[1:] != w.row[:-1])
                last = np.flatnonzero(turn)
                for s, e in zip(first.tolist(), last.tolist()):
                    r = int(w.row[s])
                    hits[r].append({"start": s - int(w.first[r]), "stop": e + 1 - int(w.first[r])})
                cols = [b.column(0).slice(i, j - i), pa.array(np.diff(w.first)), pa.array(hits, span),
                        pa.array([sorted(n) for n in names], pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(cols + ([b.column(2).slice(i, j - i)] if extra else []), ["doc_id", "n_words", "hits", "items"] + ["row"] * extra)
    schema = "doc_id long, n_words long, hits array<struct<start:int,stop:int>>, items array<string>" + ", row long" * extra
    return rows.select("doc_id", "text", *["row"] * extra).mapInArrow(run, schema)
