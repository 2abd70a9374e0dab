"""Exact dedup by composable polynomial fingerprints, with a chunkwise comparison of equal fingerprints.

Texts are equal when identical after each run of ``[\\x20\\x09-\\x0D]`` became one space.  A normalised text is read as the
digits of a number to base ``BASE`` modulo two primes.  Such fingerprints compose: that of a followed by b is
fp(a) * BASE^len(b) + fp(b), so all chunks of a batch are hashed side by side in numpy and combined by length-shifted
arithmetic; a huge text is cut into pieces that different tasks hash, combined the same way from (fingerprint, shift) rows.

Equal fingerprints are only candidates.  Texts of every fingerprint that occurs twice go chunk by chunk through one
aggregation keyed by (fingerprint, chunk number, chunk): copies inside a task collapse before the shuffle, so a hot group
costs one row a task and chunk.  One variant in every place proves the texts equal; a place with two variants is a
collision, and its texts are split by their variants.

Defined results: null and empty texts are equal (the empty text); leading or trailing white space becomes one space and counts;
the row with the smallest doc_id stays (null last; of repeated rows with that doc_id, one); an empty table gives no
rows; other columns, whatever their names, are not read by ``exact_groups``.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ripplet.llm.common import BitTable, flat_text, row_chunks
from ripplet.llm.words import byte_class, extend_hash
from ripplet.session import materialize

PRIMES = (2147483647, 2147483629)  # the two largest primes below 2^31
BASE = 1_000_003
CHUNK = 4096  # bytes hashed as one chunk
COMPARE = 1 << 15  # bytes compared as one chunk
HUGE = 1 << 24  # bytes from which a text is dealt to several tasks
TABLE_BITS = 29  # largest bit table: 64 MB

_SPACE = byte_class(b"\x20\x09\x0a\x0b\x0c\x0d")


def normalise(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) with each run of white space inside a text replaced by one space."""
    space = _SPACE[flat]
    again = np.zeros(len(flat), bool)
    again[1:] = space[1:] & space[:-1]
    heads = offsets[:-1]
    again[heads[heads < len(flat)]] = False
    kept = np.flatnonzero(~again)
    return np.where(space[kept], np.uint8(32), flat[kept]), np.searchsorted(kept, offsets)


def powers(prime: int, n: int) -> np.ndarray:
    """BASE^0 .. BASE^(n-1) modulo ``prime``, by doubling."""
    out = np.ones(max(n, 1), np.uint64)
    done = 1
    while done < n:
        step = min(done, n - done)
        out[done:done + step] = out[:step] * np.uint64(pow(BASE, done, prime)) % np.uint64(prime)
        done += step
    return out


def chunk_prints(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray, prime: int) -> np.ndarray:
    """Fingerprints of the spans (each at most CHUNK bytes), all at once."""
    out = np.zeros(len(starts), np.uint64)
    live = np.flatnonzero(ends > starts)
    if not len(live):
        return out
    size = (ends - starts)[live]
    heads = np.concatenate(([0], np.cumsum(size)[:-1]))
    at = np.arange(int(size.sum()))
    of_byte = at - np.repeat(heads, size)
    digits = flat[np.repeat(starts[live], size) + of_byte].astype(np.uint64) + np.uint64(1)
    place = np.repeat(size - 1, size) - of_byte
    out[live] = np.add.reduceat(digits * powers(prime, CHUNK)[place], heads) % np.uint64(prime)
    return out


def combine(a: tuple[int, int], b: tuple[int, int], prime: int) -> tuple[int, int]:
    """(fingerprint, shift) of a followed by b; a shift is BASE^length."""
    return (a[0] * b[1] + b[0]) % prime, a[1] * b[1] % prime


def text_prints(flat: np.ndarray, offsets: np.ndarray, primes=PRIMES) -> np.ndarray:
    """(texts, 4) array: fingerprint and shift for both primes."""
    n, block = len(offsets) - 1, (1 << 20) // CHUNK
    size = np.diff(offsets)
    many = np.maximum(-(-size // CHUNK), 1)
    of = np.repeat(np.arange(n), many)
    part = np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
    starts = offsets[of] + part * CHUNK
    ends = np.minimum(starts + CHUNK, offsets[of + 1])
    out = np.zeros((n, 4), np.int64)
    for j, prime in enumerate(primes):
        h = np.concatenate([chunk_prints(flat, starts[i:i + block], ends[i:i + block], prime) for i in range(0, len(starts), block)] or [np.zeros(0, np.uint64)])
        pw = powers(prime, CHUNK + 1)
        shift = pw[ends - starts]
        first = np.cumsum(many) - many
        fp, sh = h[first], shift[first]
        for k in range(1, int(many.max()) if n else 0):  # texts of more than k chunks take their next one
            live = np.flatnonzero(many > k)
            x = first[live] + k
            fp[live] = (fp[live] * shift[x] + h[x]) % np.uint64(prime)
            sh[live] = sh[live] * shift[x] % np.uint64(prime)
        out[:, 2 * j], out[:, 2 * j + 1] = fp.astype(np.int64), sh.astype(np.int64)
    return out


def _pack(prints: np.ndarray) -> np.ndarray:
    return (prints[:, 0] << 31) | prints[:, 2]


def _batches(batch: pa.RecordBatch, column: int):
    """(first row, row count, normalised bytes, offsets) of bounded runs of rows."""
    flat, offsets = flat_text(batch.column(column))
    for i, j in row_chunks(offsets):
        yield i, j, *normalise(flat[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])


_PRINT = "doc_id long, fp long, n_bytes long, sha string"


def _texts(docs: DataFrame):
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _whole_prints(docs: DataFrame, huge: int, primes) -> DataFrame:
    """Fingerprints of texts up to ``huge`` bytes; longer ones get a null, to be done piece by piece."""
    def run(batches):
        for b in batches:
            big = b.column(2).to_numpy(zero_copy_only=False)
            for i, j, flat, offsets in _batches(b, 1):
                fp = pa.array(_pack(text_prints(flat, offsets, primes)), mask=big[i:j])
                blob, o = flat.tobytes(), offsets.tolist()
                sha = [hashlib.sha256(blob[x:y]).hexdigest() for x, y in zip(o, o[1:])]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), fp, pa.array(np.diff(offsets).astype(np.int64)), pa.array(sha)],
                                                 ["doc_id", "fp", "n_bytes", "sha"])

    big = F.coalesce(F.octet_length("text") > huge, F.lit(False))
    return _texts(docs).select("doc_id", F.when(~big, F.col("text")).alias("text"), big.alias("big")).mapInArrow(run, _PRINT)


def _pieced_prints(docs: DataFrame, huge: int, primes) -> DataFrame:
    """Fingerprints of the texts over ``huge`` bytes: pieces go to different tasks, their prints are folded in order."""
    def cut(batches):
        for b in batches:
            for i, j, flat, offsets in _batches(b, 1):
                for r in range(j - i):
                    body = flat[offsets[r]:offsets[r + 1]].tobytes()
                    sha = hashlib.sha256(body).hexdigest()
                    for seq, at in enumerate(range(0, max(len(body), 1), huge)):
                        yield pa.RecordBatch.from_arrays([b.column(2).slice(i + r, 1), b.column(0).slice(i + r, 1), pa.array([seq], pa.int64()), pa.array([sha]),
                                                          pa.array([body[at:at + huge]], pa.binary())], ["row", "doc_id", "seq", "sha", "piece"])

    def hash_pieces(batches):
        for b in batches:
            for i, part in enumerate(b.column(4)):
                body = np.frombuffer(part.as_buffer(), np.uint8)
                x = text_prints(body, np.array([0, len(body)]), primes)[0].tolist()
                yield pa.RecordBatch.from_arrays([*(b.column(c).slice(i, 1) for c in range(4)), *(pa.array([v], pa.int64()) for v in x),
                                                  pa.array([len(body)], pa.int64())],
                                                 ["row", "doc_id", "seq", "sha", "h1", "s1", "h2", "s2", "size"])

    texts = _texts(docs).where(F.octet_length("text") > huge).withColumn("row", F.monotonically_increasing_id())
    pieces = (texts.mapInArrow(cut, "row long, doc_id long, seq long, sha string, piece binary").repartition("row", "seq")
              .mapInArrow(hash_pieces, "row long, doc_id long, seq long, sha string, h1 long, s1 long, h2 long, s2 long, size long"))

    def folded(h: str, s: str, prime: int):
        return F.aggregate("parts", F.lit(0).cast("long"), lambda acc, x: F.pmod(acc * x[s] + x[h], F.lit(prime).cast("long")))

    return (pieces.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("sha").alias("sha"), F.sum("size").alias("n_bytes"),
                                      F.array_sort(F.collect_list(F.struct("seq", "h1", "s1", "h2", "s2"))).alias("parts"))
            .select("doc_id", F.shiftleft(folded("h1", "s1", primes[0]), 31).bitwiseOR(folded("h2", "s2", primes[1])).alias("fp"), "n_bytes", "sha"))


def fingerprints(docs: DataFrame, huge: int = HUGE, primes=PRIMES) -> DataFrame:
    """(doc_id, fp, n_bytes, sha): fingerprint, size and SHA-256 of each normalised text, written once."""
    printed = materialize(_whole_prints(docs, huge, primes), "exact-prints")
    if printed.where("fp IS NULL").isEmpty():
        return printed
    return materialize(printed.where("fp IS NOT NULL").unionByName(_pieced_prints(docs, huge, primes)), "exact-prints")


def _place(fp: np.ndarray, bits: int) -> np.ndarray:
    return (extend_hash(fp.astype(np.uint64), np.uint64(0)) >> np.uint64(64 - bits)).astype(np.int64)


def _rows(names: list[str], held: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in held[:-1]), pa.array(held[-1], pa.binary())], names)


def _chunks_of_repeats(docs: DataFrame, repeats: DataFrame, primes, keep_row: bool = False) -> DataFrame:
    """(fp, n_bytes, seq, chunk) rows of the texts whose fingerprint may be in ``repeats`` (a bit table sized by their number
    thins the scan; what passes by collision has one variant a place and does no harm)."""
    bits = min(TABLE_BITS, max(16, (16 * repeats.count()).bit_length()))

    def places(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_place(b.column(0).to_numpy(), bits))], ["at"])

    cast = BitTable.of(repeats.select("fp").mapInArrow(places, "at long"), bits).table

    def run(batches):
        names = ["row", "doc_id", "fp", "n_bytes", "seq", "chunk"]
        for b in batches:
            held, size = [[] for _ in names], 0
            for i, j, flat, offsets in _batches(b, 1):
                fp = _pack(text_prints(flat, offsets, primes))
                for r in np.flatnonzero(BitTable.test(cast.value, _place(fp, bits))).tolist():
                    body = flat[offsets[r]:offsets[r + 1]].tobytes()
                    head = (b.column(2)[i + r].as_py(), b.column(0)[i + r].as_py(), int(fp[r]), len(body))
                    for seq, at in enumerate(range(0, max(len(body), 1), COMPARE)):
                        for into, x in zip(held, (*head, seq, body[at:at + COMPARE])):
                            into.append(x)
                        size += COMPARE if len(body) > at + COMPARE else len(body) - at
                        if size >= 1 << 21:
                            yield _rows(names, held)
                            held, size = [[] for _ in names], 0
            if held[0]:
                yield _rows(names, held)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                        (F.monotonically_increasing_id() if keep_row else F.lit(0).cast("long")).alias("row"))
    return texts.mapInArrow(run, "row long, doc_id long, fp long, n_bytes long, seq long, chunk binary")


def _split_collisions(docs: DataFrame, printed: DataFrame, clash: DataFrame, primes) -> DataFrame:
    """(doc_id, fp, n_bytes, sha, class) of the rows whose fingerprint belongs to different texts: the class lists, place by
    place, which variant of the chunk a row holds."""
    rows = _chunks_of_repeats(docs, clash, primes, keep_row=True)
    rows = materialize(rows.join(clash, ["fp", "n_bytes"], "left_semi"), "exact-clash")
    variants = rows.select("fp", "n_bytes", "seq", "chunk").distinct()
    number = F.row_number().over(Window.partitionBy("fp", "n_bytes", "seq").orderBy("chunk"))
    variants = materialize(variants.withColumn("variant", number), "exact-variants")
    whole = (rows.join(variants, ["fp", "n_bytes", "seq", "chunk"]).groupBy("row", "doc_id", "fp", "n_bytes")
             .agg(F.array_sort(F.collect_list(F.struct("seq", "variant", "chunk"))).alias("v")))
    return whole.select("doc_id", "fp", "n_bytes", F.sha2(F.aggregate("v", F.lit(b""), lambda acc, x: F.concat(acc, x["chunk"])), 256).alias("sha"),
                        F.array_join(F.transform("v", lambda x: x["variant"].cast("string")), ",").alias("class"))


def exact_groups(docs: DataFrame, huge: int = HUGE, primes=PRIMES) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per input row."""
    printed = fingerprints(docs, huge, primes)
    repeats = materialize(printed.groupBy("fp", "n_bytes").count().where("count > 1").select("fp", "n_bytes"), "exact-repeats")
    variants = _chunks_of_repeats(docs, repeats, primes).groupBy("fp", "n_bytes", "seq", "chunk").agg(F.count("*").alias("c"))
    clash = materialize(variants.groupBy("fp", "n_bytes", "seq").agg(F.count("*").alias("c")).where("c > 1")
                        .select("fp", "n_bytes").distinct(), "exact-clashes")
    plain = printed.withColumn("class", F.lit(""))
    if clash.isEmpty():
        rows = plain
    else:
        rows = materialize(plain.join(clash, ["fp", "n_bytes"], "left_anti").unionByName(_split_collisions(docs, printed, clash, primes)), "exact-rows")
    of = ["fp", "n_bytes", "class"]
    groups = rows.groupBy(*of).agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    both = rows.join(groups, of).withColumn("lead", F.col("doc_id").eqNullSafe(F.col("keep_id")))
    first = Window.partitionBy(*of, "doc_id").orderBy(F.lit(0))
    out = ["doc_id", "keep_id", "group_size"]
    lead = both.where("lead").select(*out, (F.row_number().over(first) == 1).alias("kept"), F.col("sha").alias("text_sha256"))
    rest = both.where("NOT lead").select(*out, F.lit(False).alias("kept"), F.col("sha").alias("text_sha256"))
    return lead.unionByName(rest)
