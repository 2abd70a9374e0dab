"""Phrase collocation mining: n-grams counted in a burstable HAT-trie per task, spilled as sorted runs, merged per prefix.

Text is lower-cased (A-Z), split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those into words ``[^\\x20\\x09]+``.  A phrase
never crosses a piece.  All counts are per ``lang`` (null: ``und``) and exact.

Counting goes one length at a time, 1 to ``longest``.  A phrase of k words can reach ``least`` occurrences only if its first
and last k - 1 words do, so occurrences without that are skipped (a bit table of the frequent shorter phrases, sized by
their number; a false positive only lets a rare phrase be counted, and the exact sums drop it).  Each task numbers its
words and counts phrases in a trie: hash containers keyed by the rest of the phrase hang below a shallow trie of word ids; a
container that outgrows ``BURST`` bursts into a trie node.  When a task's tries pass ``ENTRIES`` phrases, the largest
subtrees leave whole, as sorted compressed runs, one for each prefix partition (a hash of the first two words, so a hot
first word is many partitions); Spark deals the runs by language and partition, where equal phrases are added up.  A hot
phrase reaches the shuffle once per run, not once per occurrence.

Defined results: null or empty texts and texts without words count nothing; an empty table gives no rows; a very long
text is read in parts that overlap by k - 1 words, never cut to a prefix; repeated rows count each time; other columns,
whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ripplet.llm.common import BitTable
from ripplet.llm.words import byte_class, cut_long, extend_hash, hash_words, number_words, word_spans
from ripplet.session import materialize

WINDOW_BYTES = 1 << 22
BURST = 2048
ENTRIES = 600_000
PARTITION_BYTES = 1 << 23  # text per prefix partition; its runs hold a few times that at most, unpacked
WORD_LIMIT = 500_000  # distinct words a task remembers before all its tries leave
TABLE_BITS = 29  # largest bit table: 64 MB

_GAPS = b"\x20\x09"
_BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
_IS_WORD = ~byte_class(_GAPS + _BREAKS)
_IS_BREAK = byte_class(_BREAKS)
_ID = 4  # bytes of a word id in a trie key


class Container(dict):
    """Leaf of the trie: rest of the phrase -> count."""


class HatTrie:
    """Counts of fixed-length phrases; a key is the word ids, 4 bytes each."""

    def __init__(self, burst: int = BURST):
        self.root, self.burst = Container(), burst
        self.sizes: dict[bytes, int] = {}  # phrases below each first word
        self.size = 0

    def add(self, head: bytes, rests: list[bytes], counts: list[int]) -> None:
        """Phrases that begin with the word ``head``, by the rest of their keys."""
        if type(self.root) is Container:
            before = len(self.root)
            self._fill(self.root, [head + r for r in rests], counts)
            self.size += len(self.root) - before
            self.sizes[head] = self.sizes.get(head, 0) + len(self.root) - before
            if len(self.root) > self.burst and rests[0]:
                self.root = self._burst(self.root)
            return
        added = self._insert(self.root, head, rests, counts)
        self.sizes[head] = self.sizes.get(head, 0) + added
        self.size += added

    def _insert(self, parent: dict, head: bytes, rests: list[bytes], counts: list[int]) -> int:
        node = parent.get(head)
        if node is None:
            node = parent[head] = Container()
        if type(node) is not Container:
            return sum(self._insert(node, r[:_ID], [r[_ID:]], [c]) for r, c in zip(rests, counts))
        before = len(node)
        self._fill(node, rests, counts)
        if len(node) > self.burst and len(rests[0]) > _ID:
            parent[head] = self._burst(node)
        return len(node) - before

    @staticmethod
    def _fill(node: Container, rests: list[bytes], counts: list[int]) -> None:
        get = node.get
        for r, c in zip(rests, counts):
            node[r] = get(r, 0) + c

    @staticmethod
    def _burst(node: Container) -> dict:
        grown: dict = {}
        for k, v in node.items():
            grown.setdefault(k[:_ID], Container())[k[_ID:]] = v
        return grown

    def take(self, share: float = 1.0) -> tuple[bytes, list[int]]:
        """(keys one after another, counts) of whole subtrees below the root, largest first, until ``share`` of the phrases has left."""
        if type(self.root) is Container or share >= 1:
            roots = [(b"", self.root)]
            self.root, self.sizes, self.size = Container(), {}, 0
        else:
            goal, roots = self.size * (1 - share), []
            for head in sorted(self.sizes, key=self.sizes.get, reverse=True):
                if self.size <= goal:
                    break
                self.size -= self.sizes.pop(head)
                roots.append((head, self.root.pop(head)))
        keys, counts = [], []
        while roots:
            path, node = roots.pop()
            if type(node) is Container:
                keys += [path + rest for rest in node]
                counts += node.values()
            else:
                roots += [(path + head, child) for head, child in node.items()]
        return b"".join(keys), counts


class _Counter:
    """The tries of one task, one for each language, and the words they number."""

    def __init__(self, length: int, limit: int, partitions: int):
        self.length, self.limit, self.partitions = length, limit, partitions
        self.tries: dict[str, HatTrie] = {}
        self.ids: dict[bytes, int] = {}
        self.names: list[bytes] = []

    def count(self, lang: str, words: list[bytes], phrases: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Add phrases (rows of numbers into ``words``); yields the runs that have to leave."""
        used, phrases = np.unique(phrases, return_inverse=True)
        own = np.empty(len(used), ">u4")
        for i, u in enumerate(used.tolist()):
            w = words[u]
            known = self.ids.get(w)
            if known is None:
                known = self.ids[w] = len(self.names)
                self.names.append(w)
            own[i] = known
        phrases = own[phrases]
        order = np.argsort(phrases[:, 0], kind="stable")
        phrases, n = phrases[order], n[order].tolist()
        cuts = np.flatnonzero(np.concatenate(([True], phrases[1:, 0] != phrases[:-1, 0], [True]))).tolist()
        raw, width = phrases.tobytes(), _ID * self.length
        rests = [raw[i + _ID:i + width] for i in range(0, len(raw), width)]
        trie = self.tries.get(lang)
        if trie is None:
            trie = self.tries[lang] = HatTrie()
        for x, y in zip(cuts, cuts[1:]):
            trie.add(raw[x * width:x * width + _ID], rests[x:y], n[x:y])
        if len(self.names) > WORD_LIMIT or sum(t.size for t in self.tries.values()) >= self.limit:
            yield from self.spill(1.0 if len(self.names) > WORD_LIMIT else 0.5)

    def spill(self, share: float) -> Iterator[pa.RecordBatch]:
        """What leaves, as one sorted run for each prefix partition."""
        flat = np.frombuffer(b"\n".join(self.names), np.uint8)
        hashes = hash_words(flat, *word_spans(flat, _IS_WORD)) if self.names else np.zeros(0, np.uint64)
        names = pa.array(self.names, pa.large_binary())
        for lang, trie in self.tries.items():
            keys, counts = trie.take(share)
            if not counts:
                continue
            ids = np.frombuffer(keys, ">u4").reshape(-1, self.length).astype(np.int64)
            prefix = hashes[ids[:, 0]]
            if self.length > 1:
                prefix = extend_hash(prefix, hashes[ids[:, 1]])
            part = (prefix % np.uint64(self.partitions)).astype(np.int32)
            words = [names.take(pa.array(ids[:, i])) for i in range(self.length)]
            texts = pc.binary_join_element_wise(*words, pa.scalar(b" ", pa.large_binary())) if self.length > 1 else words[0]
            order = pc.sort_indices(pa.table({"part": part, "text": texts}), [("part", "ascending"), ("text", "ascending")])
            part, texts = part[order.to_numpy()], texts.take(order).to_pylist()
            n = np.array(counts, np.int64)[order.to_numpy()]
            cuts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1], [True]))).tolist()
            runs = [pack_run(texts[x:y], n[x:y]) for x, y in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(runs), pa.string()), pa.array(part[cuts[:-1]]), pa.array(runs, pa.binary())],
                                             ["lang", "part", "run"])
        if share >= 1:
            self.tries, self.ids, self.names = {}, {}, []


def pack_run(phrases: list[bytes], n: np.ndarray) -> bytes:
    """A sorted run, compressed: sizes, phrases one a line, counts."""
    small = np.minimum(n, 255).astype(np.uint8)
    text = b"\n".join(phrases)
    body = text + small.tobytes() + n[n >= 255].astype("<i8").tobytes()
    return np.array([len(n), len(text), len(body)], "<u8").tobytes() + pa.compress(body, "zstd", asbytes=True)


def unpack_run(blob: bytes) -> tuple[pa.Array, np.ndarray]:
    rows, text, size = np.frombuffer(blob[:24], "<u8").tolist()
    body = pa.decompress(blob[24:], size, "zstd", asbytes=True)
    n = np.frombuffer(body, np.uint8, rows, text).astype(np.int64)
    n[n == 255] = np.frombuffer(body, "<i8", -1, text + rows)
    return pa.array(body[:text].split(b"\n"), pa.binary()), n


def _merge_runs(least: int):
    """Group function of a prefix partition: equal phrases of its runs are added up, rare ones go."""
    def merge(key, group):
        lang, part = (k.as_py() for k in key)
        blobs = group["run"].to_pylist()
        if part < 0:
            phrase, n = pa.nulls(1, pa.string()), pa.array([sum(int.from_bytes(x, "little") for x in blobs)], pa.int64())
        else:
            runs = [unpack_run(x) for x in blobs]
            table = pa.table({"phrase": pa.chunked_array([p for p, _ in runs]), "n": np.concatenate([n for _, n in runs])})
            table = table.group_by("phrase").aggregate([("n", "sum")])
            table = table.filter(pc.greater_equal(table["n_sum"], least)).combine_chunks()
            phrase, n = table["phrase"].cast(pa.string()), table["n_sum"]
        return pa.table({"lang": pa.array([lang] * len(n), pa.string()), "phrase": phrase, "n": n})
    return merge


def _lang_seed(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh64_intdigest(lang.encode(), 11))


def _table_places(seed: np.uint64, word_hashes: list[np.ndarray], bits: int) -> np.ndarray:
    h = extend_hash(np.full(len(word_hashes[0]), seed), word_hashes[0])
    for w in word_hashes[1:]:
        h = extend_hash(h, w)
    return (h >> np.uint64(64 - bits)).astype(np.int64)


def _table_of(phrases: DataFrame, length: int) -> tuple[BitTable, int]:
    """Bit table of frequent phrases of ``length`` words, 32 to 64 bits a phrase up to the largest size."""
    rows = phrases.count()
    bits = min(TABLE_BITS, max(16, (32 * rows).bit_length()))

    def places(batches):
        for b in batches:
            texts = b.column(1).cast(pa.binary()).to_pylist()
            flat = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
            starts, ends = word_spans(flat, _IS_WORD)
            h = hash_words(flat, starts, ends).reshape(-1, length)
            seeds = {lang: _lang_seed(lang) for lang in set(b.column(0).to_pylist())}
            seed = np.array([seeds[lang] for lang in b.column(0).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(_table_places(seed, [h[:, i] for i in range(length)], bits))], ["at"])

    return BitTable.of(phrases.select("lang", "phrase").mapInArrow(places, "at long"), bits), bits


def _joined_texts(batch: pa.RecordBatch) -> Iterator[tuple[str, bytes]]:
    """(lang, lower-cased texts joined by line breaks), bounded windows; a long text comes alone."""
    langs, texts = batch.column(0).to_pylist(), batch.column(1)
    held: dict[str, list[bytes]] = {}
    size: dict[str, int] = {}
    for i, lang in enumerate(langs):
        text = texts[i].as_py()
        if not text:
            continue
        blob = text.encode().lower()
        if len(blob) > WINDOW_BYTES:
            yield lang, blob
            continue
        held.setdefault(lang, []).append(blob)
        size[lang] = size.get(lang, 0) + len(blob)
        if size[lang] >= WINDOW_BYTES:
            yield lang, b"\n".join(held.pop(lang))
            size[lang] = 0
    for lang, parts in held.items():
        yield lang, b"\n".join(parts)


def _occurrences(blob: bytes, length: int, seed: np.uint64, table: np.ndarray | None, bits: int, window: int = WINDOW_BYTES):
    """(words, phrases, counts, occurrences of words) of each part of a text; parts overlap by ``length - 1`` words."""
    carry = b""
    for part, more in cut_long(blob, window, _IS_WORD):
        flat = np.frombuffer(carry + part, np.uint8)
        starts, ends = word_spans(flat, _IS_WORD)
        old = int(np.searchsorted(starts, len(carry)))
        piece = np.cumsum(_IS_BREAK[flat], dtype=np.int64)[starts] if len(starts) else starts
        carry = flat[starts[-min(length - 1, len(starts))]:].tobytes() if more and length > 1 and len(starts) else b""
        fresh, spots = len(starts) - old, len(starts) - length + 1
        if spots <= 0:
            yield [], np.zeros((0, length), np.int64), np.zeros(0, np.int64), fresh
            continue
        number, words, h = number_words(flat, starts, ends)
        first = np.arange(spots)
        keep = (piece[:spots] == piece[length - 1:]) & (first + length > old)
        if table is not None:
            ph = [h[number[i:len(number) - length + 2 + i]] for i in range(length - 1)]
            alive = BitTable.test(table, _table_places(seed, ph, bits))
            keep &= alive[:spots] & alive[1:spots + 1]
        first = first[keep]
        node = number[first]
        for i in range(1, length):  # exact numbers of longer and longer phrases: (number of the start, next word)
            node = np.unique(node.astype(np.int64) * len(words) + number[first + i], return_inverse=True)[1]
        _, one, n = np.unique(node, return_index=True, return_counts=True)
        spot = first[one]
        yield words, number[spot[:, None] + np.arange(length)], n, fresh


def count_phrases(docs: DataFrame, length: int, least: int, partitions: int, frequent: DataFrame | None = None, entries: int = ENTRIES) -> DataFrame:
    """(lang, phrase, n): exact counts, ``least`` or more, of the phrases of ``length`` words whose shorter parts are in
    ``frequent``.  With length 1 a row with a null phrase holds the number of all words."""
    table, bits = (None, 0) if frequent is None else _table_of(frequent, length - 1)
    cast = None if table is None else table.table

    def run(batches):
        counter, totals = _Counter(length, entries, partitions), {}
        bit_table = None if cast is None else cast.value
        for b in batches:
            for lang, blob in _joined_texts(b):
                for words, phrases, n, fresh in _occurrences(blob, length, _lang_seed(lang), bit_table, bits):
                    totals[lang] = totals.get(lang, 0) + fresh
                    if len(n):
                        yield from counter.count(lang, words, phrases, n)
        yield from counter.spill(1.0)
        if length == 1 and totals:
            yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.string()), pa.array([-1] * len(totals), pa.int32()),
                                              pa.array([x.to_bytes(8, "little") for x in totals.values()], pa.binary())], ["lang", "part", "run"])

    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    runs = texts.mapInArrow(run, "lang string, part int, run binary")
    return runs.groupBy("lang", "part").applyInArrow(_merge_runs(least), "lang string, phrase string, n long")


def collocations(docs: DataFrame, longest: int = 5, least: int = 100, inside_percent: int = 100, top: int = 2000, entries: int = ENTRIES) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the best phrases of each language.

    Candidates are phrases of 2 to ``longest`` words with a >= ``least`` occurrences; the lowest
    floor(1000 a n / (l r)) over all cuts counts (ties to the shortest first part).  A candidate goes if one longer by a
    word holds it and 100 f(longer) >= inside_percent a (a still longer one implies that one, as counts only fall)."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    partitions = max(8, -(-size // PARTITION_BYTES))
    words = materialize(count_phrases(docs, 1, least, partitions, entries=entries), "phrase-words")
    levels = [words.where("phrase IS NOT NULL")]
    for k in range(2, longest + 1):
        levels.append(materialize(count_phrases(docs, k, least, partitions, levels[-1], entries), f"phrase-{k}"))
    known = levels[0]
    for x in levels[1:]:
        known = known.unionByName(x)
    w = F.split("phrase", " ", -1)
    found = known.where(F.size(w) > 1).select("lang", "phrase", F.col("n").alias("a"))

    covers = None
    for x in levels[2:]:
        part = x.select("lang", F.col("n").alias("outer"), F.explode(F.array(
            F.array_join(F.slice(w, 1, F.size(w) - 1), " "), F.array_join(F.slice(w, 2, F.size(w) - 1), " "))).alias("phrase"))
        covers = part if covers is None else covers.unionByName(part)
    if covers is not None:
        covers = covers.groupBy("lang", "phrase").agg(F.max("outer").alias("outer"))
        found = found.join(covers, ["lang", "phrase"], "left").where(
            F.col("outer").isNull() | (F.col("outer").cast("decimal(38,0)") * 100 < F.col("a").cast("decimal(38,0)") * inside_percent)).drop("outer")

    cuts = found.select("lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.size(w) - 1)).alias("k"), w.alias("w"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("left"),
                       F.array_join(F.slice("w", F.col("k") + 1, F.size("w") - F.col("k")), " ").alias("right"))
    totals = materialize(words.where("phrase IS NULL").select("lang", "n").coalesce(1), "phrase-totals")  # a row a language
    cuts = (cuts.join(known.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l")), ["lang", "left"])
            .join(known.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r")), ["lang", "right"]))
    scored = cuts.join(totals, "lang").select(
        "lang", "phrase", "a", "l", "r", "n", "k",
        F.expr("CAST((CAST(a AS DECIMAL(38,0)) * 1000 * n) DIV (CAST(l AS DECIMAL(38,0)) * r) AS BIGINT)").alias("score"))
    best = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a", "n")).alias("b")).select(
        "lang", "phrase", "b.a", "b.l", "b.r", "b.n", "b.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
