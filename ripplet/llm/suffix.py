"""Suffix-array dedup with a run-length index: long byte matches with earlier documents are marked and cut out.

Texts are UTF-8 bytes.  A byte goes if a ``length``-byte string that covers it also starts in a document of smaller
doc_id; matches never cross documents and are judged on the input.

Where to look.  Of every ``length``-byte window, the smallest hash among its strings of a given length is the anchor, so
equal windows have equal anchors.  A first pass sends the hashes of long anchors (each group of chunks an anchor once,
packed) to parts by their leading bits, and a part finds those that several documents have.  Up to ``TABLE_TEXT`` bytes
of text they become a bit table of fixed size, which lets all of them pass, and others only by collision.  A table of
fixed size fills up and one that grows does not stay a broadcast, so for more text the groups are written once, each part answers
every group with a bit for each anchor that it sent, and groups and answers meet by the group's number.
The second pass leaves out the windows whose long anchor does not pass, cuts the
rest into the maximal pieces whose windows share a short anchor, and sends each piece to the bucket of that anchor.
A group of chunks sends equal pieces once, so a passage that a third of all documents share is one row for each.

Matching.  A short anchor with one distinct piece has nothing else to match: all documents after its first lose the piece.
The other distinct pieces of a bucket, in the order of their first document, become a run-length index: the
Burrows-Wheeler transform of the collection is kept as runs (starts, symbols, counts) with the text positions at run
ends as samples.  Streaming the pieces through LF steps, all at once from their last byte to the first, gives the row of
every window; rows that agree on ``length`` bytes form an interval, for which the index holds the first document.
A window whose interval starts in an earlier document is a long match (its matching statistic reaches ``length``).

Null and empty texts have no byte.  A null doc_id is no document to compare with: such rows stay whole and mark nothing.
Rows that repeat a doc_id are one document; their texts are told apart by a hash.  Extra columns are not read.  A very long
text is cut into parts that overlap by ``length - 1`` bytes; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ripplet.llm.common import BitTable, flat_text, row_chunks
from ripplet.llm.words import mix
from ripplet.session import drop_table, materialize

TABLE_BITS = 27  # 16 MB
TABLE_TEXT = 1 << 27  # text whose shared anchors fill a few hundredths of that table
PART_TEXT = 1 << 24  # text whose anchors meet in one part where there is no table
ROW_BITS = 25
CHUNK_BYTES = 1 << 17  # text whose anchors are found at once: arrays of that size stay in a core's cache
GROUP_BYTES = 1 << 22  # text whose equal anchors and pieces are sent once
TABLE_HASHES = 3  # bits of an anchor, all in one word of the table
BUCKET_BYTES = 1 << 18  # input text per bucket; a bucket holds a few times its shared part
PACK = 4  # symbols of the first sort key
_BASE, _MIX = 0x9E3779B97F4A7C15, np.uint64(0xD6E8FEB86659FD93)
_SYMBOLS = np.random.default_rng(20240304).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)  # of the bytes, in hashes
_POWERS: list[np.ndarray] = []


def _powers(n: int):
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 16)
        _POWERS[:] = [np.cumprod(np.full(size, b, np.uint64)) for b in (_BASE, pow(_BASE, -1, 1 << 64))]
    return _POWERS[0][:n], _POWERS[1][:n]


class Anchors:
    """Anchors of all ``length``-byte windows of a flat text: ``first`` and ``last`` window start of each maximal run with
    one anchor, the anchor's position ``at`` and ``hash``, and the ``row`` it is in."""

    def __init__(self, flat: np.ndarray, offsets: np.ndarray, length: int):
        self.length, self.offsets, n = length, offsets, len(flat)
        power, inverse = _powers(n + 1)
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_SYMBOLS[flat] * power[:-1])))
        self.inverse, self.n = inverse, n
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:max(0, n - length + 1)]
        self.inside = np.flatnonzero(np.arange(len(row)) + length <= offsets[row + 1])
        self.window_row = row[self.inside]

    def of(self, gram: int, windows: np.ndarray | None = None):
        """(first, last, at, hash, row) for anchors of ``gram`` bytes; ``windows`` (a mask of ``inside``) leaves others out."""
        inside, r = self.inside, self.window_row
        if windows is not None:
            inside, r = inside[windows], r[windows]
        if not len(inside):
            z = np.zeros(0, np.int64)
            return z, z, z, z.astype(np.uint64), z
        h = (self.sums[gram:] - self.sums[:-gram]) * self.inverse[:self.n - gram + 1]
        h = (h ^ (h >> np.uint64(32))) * _MIX
        h ^= h >> np.uint64(29)
        bits = np.uint64(max(24, self.n.bit_length()))
        low = ((h >> bits) << bits) | np.arange(len(h), dtype=np.uint64)  # the leftmost of equal hashes
        span, width = 1, self.length - gram + 1
        while 2 * span <= width:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        if span < width:
            low = np.minimum(low[:-(width - span)], low[width - span:])
        at = (low[inside] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        head = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (inside[1:] != inside[:-1] + 1) | (r[1:] != r[:-1]))))
        last = np.append(head[1:], len(at)) - 1
        return inside[head], inside[last], at[head], h[at[head]], r[head]


    def ids(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """64-bit hash of each piece [start, stop)."""
        return mix((self.sums[stop] - self.sums[start]) * self.inverse[start]).view(np.int64)


def even(anchor: np.ndarray) -> np.ndarray:
    """Anchor hashes, which are minima and so crowd at the low end, dealt out evenly."""
    return mix(anchor * np.uint64(_BASE))


def table_places(anchor: np.ndarray, width: int, bits: int):
    """Places of ``width``-bit anchors in a table of 2^``bits`` bits: the leading bits name the word, those after them the
    bits in it."""
    word = anchor >> (width - bits + 5) << 5
    for k in range(TABLE_HASHES):
        yield word | (anchor >> (width - bits - 5 * k)) & 31


def bounded_rows(offsets: np.ndarray, length: int, limit: int = CHUNK_BYTES):
    """(first byte, last byte, offsets inside, first row, bytes of that row before) of bounded parts.  A row longer than
    ``limit`` is cut into parts that overlap by ``length - 1`` bytes, so each window is in exactly one."""
    for i, j in row_chunks(offsets, limit):
        start, stop = int(offsets[i]), int(offsets[j])
        if j > i + 1 or stop - start <= limit:
            yield start, stop, offsets[i:j + 1] - start, i, 0
            continue
        for at in range(start, max(start + 1, stop - length + 1), limit):
            end = min(at + limit + length - 1, stop)
            yield at, end, np.array([0, end - at]), i, at - start


def grouped(parts, limit: int = GROUP_BYTES):
    """Lists of consecutive bounded parts of about ``limit`` bytes together."""
    got, size = [], 0
    for p in parts:
        got.append(p)
        size += p[1] - p[0]
        if size >= limit:
            yield got
            got, size = [], 0
    if got:
        yield got


def pack_sorted(values: np.ndarray) -> bytes:
    """Sorted distinct 32-bit integers as compressed byte planes of their differences."""
    delta = np.diff(values, prepend=np.uint32(0)).astype("<u4")
    return np.uint32(len(delta)).tobytes() + pa.compress(np.ascontiguousarray(delta.view(np.uint8).reshape(-1, 4).T).tobytes(), "zstd", asbytes=True)


def unpack_sorted(blob: bytes) -> np.ndarray:
    n = int(np.frombuffer(blob[:4], "<u4")[0])
    planes = np.frombuffer(pa.decompress(blob[4:], 4 * n, "zstd", asbytes=True), np.uint8).reshape(4, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.uint32)


class RunLengthIndex:
    """Run-compressed BWT of a list of byte strings, each with its own end mark (string number i sorts by i).

    Rows 0..m-1 are the end marks.  ``starts``/``heads``/``before`` describe the BWT's runs (first row, symbol, rows of
    that symbol before the run), ``samples`` the text position at each run's last row, ``first`` the first row of each
    symbol.  ``classes`` are the first rows of the intervals that agree on ``length`` symbols, ``owner`` the smallest
    string number in each."""

    def __init__(self, strings: list[bytes], length: int):
        m = len(strings)
        size = np.array([len(s) for s in strings], np.int64) + 1
        self.m, self.size = m, size
        end = np.cumsum(size) - 1
        n = int(size.sum())
        text = np.zeros(n, np.int64)  # 0 is an end mark, a byte b is b + 1
        body = np.ones(n, bool)
        body[end] = False
        text[body] = np.frombuffer(b"".join(strings), np.uint8).astype(np.int64) + 1
        of = np.repeat(np.arange(m), size)
        stop = end[of]
        key = np.zeros(n, np.int64)
        place = np.arange(n)
        for k in range(PACK):
            key = key * 257 + text[np.minimum(place + k, stop)]
        key += m
        key[end] = np.arange(m)  # an end mark stands for its string number: smaller than any other suffix
        order, rank = self._rank(key)
        depth, half = PACK, None
        while depth < int(size.max()) + 1:
            if half is None and 2 * depth >= length:
                half = (rank, depth)
            ahead = rank[np.minimum(place + depth, stop)]
            order, rank = self._rank(rank * (n + 1) + ahead)
            depth *= 2
        if half is None:
            half = (rank, min(depth, length))
        self.length = length
        prev = np.where(order > 0, text[order - 1], 0)
        begins = np.zeros(n, bool)
        begins[np.append(0, end[:-1] + 1)] = True
        prev[begins[order]] = 0
        # rows at a string's start are runs of their own, so that every walk to the left meets a sample
        turn = np.concatenate(([True], (prev[1:] != prev[:-1]) | (prev[1:] == 0)))
        self.starts = np.flatnonzero(turn)
        self.heads = prev[self.starts]
        runs = np.diff(np.append(self.starts, n))
        o = np.argsort(self.heads, kind="stable")
        total = np.cumsum(runs[o]) - runs[o]
        head_sorted = self.heads[o]
        base = total[np.searchsorted(head_sorted, head_sorted)]
        self.before = np.empty(len(runs), np.int64)
        self.before[o] = total - base
        count = np.bincount(text, minlength=257)
        self.first = np.cumsum(count) - count
        # rank support: the run of each row, and what LF adds to a row of the run
        self.run_of = np.repeat(np.arange(len(runs), dtype=np.int32), runs)
        self.step = self.first[self.heads] + self.before - self.starts
        self.samples = order[np.append(self.starts[1:], n) - 1]
        # intervals of equal length-symbol prefixes that end before the string does
        r, d = half
        x, y = order[:-1], order[1:]
        long_x, long_y = x + length <= stop[x], y + length <= stop[y]
        shift = max(0, length - d)
        same = long_x & long_y & (r[x] == r[y]) & (r[np.minimum(x + shift, n - 1)] == r[np.minimum(y + shift, n - 1)])
        turn = np.concatenate(([True], ~same))
        self.classes = np.flatnonzero(turn)
        self.class_of = (np.cumsum(turn) - 1).astype(np.int32)
        self.owner = np.minimum.reduceat(of[order], self.classes)

    @staticmethod
    def _rank(key: np.ndarray):
        """(order, rank) of the keys; ranks are dense and equal for equal keys."""
        n = len(key)
        bits = max(1, (n - 1).bit_length())
        if int(key.max()).bit_length() + bits <= 63:  # sorting (key, place) in one word is several times faster
            packed = np.sort((key << bits) | np.arange(n))
            order, s = packed & ((1 << bits) - 1), packed >> bits
        else:
            order = np.argsort(key)
            s = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate(([0], np.cumsum(s[1:] != s[:-1])))
        return order, rank

    def lf(self, row: np.ndarray) -> np.ndarray:
        """Row of the suffix that is one symbol longer (undefined where the symbol is an end mark)."""
        k = self.run_of[row]
        return self.step[k] + row

    def stream(self):
        """For every window of ``length`` bytes: (string number, offset, smallest string number that holds it)."""
        live = np.flatnonzero(self.size > self.length)
        row, offset = live.copy(), self.size[live] - 1
        out = []
        while len(live):
            row = self.lf(row)
            offset = offset - 1
            ready = offset + self.length < self.size[live]
            if ready.any():
                out.append((live[ready], offset[ready], self.owner[self.class_of[row[ready]]]))
            more = offset > 0
            live, row, offset = live[more], row[more], offset[more]
        if not out:
            z = np.zeros(0, np.int64)
            return z, z, z
        return tuple(np.concatenate(x) for x in zip(*out))

    def locate(self, row: int) -> int:
        """Text position of a row: LF steps up to a sampled run end."""
        steps = 0
        ends = np.append(self.starts[1:], int(self.size.sum())) - 1
        while True:
            k = int(self.run_of[row])
            if ends[k] == row:
                return int(self.samples[k]) + steps
            row, steps = int(self.lf(np.array([row]))[0]), steps + 1


def _strings(flat: np.ndarray, start: np.ndarray, stop: np.ndarray, null: np.ndarray, at_once: int = 1 << 14) -> pa.Array:
    """The pieces [start, stop) of a flat text as a binary column."""
    size = stop - start
    end = np.cumsum(size)
    data = [flat[np.arange(end[k - 1] if k else 0, end[min(k + at_once, len(end)) - 1]) + np.repeat((start - end + size)[k:k + at_once], size[k:k + at_once])]
            for k in range(0, len(end), at_once)]
    return pa.Array.from_buffers(pa.binary(), len(end), [pa.py_buffer(np.packbits(~null, bitorder="little")),
                                                         pa.py_buffer(np.append(0, end).astype(np.int32)), pa.py_buffer(np.concatenate(data))])


def anchor_keys(flat: np.ndarray, group, length: int, gram: int, part_bits: int):
    """Keys of the long anchors of each bounded part of a group, in text order, and the rows they are in.  A key's leading
    bits name its part, the last 32 tell it from others there."""
    keys, rows = [], []
    for x, y, inside, i, _ in group:
        _, _, _, h, row = Anchors(flat[x:y], inside, length).of(gram)
        keys.append(even(h) >> np.uint64(32 - part_bits))
        rows.append((row + i).astype(np.int32))
    return keys, rows


def packed_keys(key: np.ndarray, row: np.ndarray, gid: int) -> pa.RecordBatch:
    """One row per part: the distinct keys of a group, sorted, and a bit for each that several rows of the group have."""
    o = np.argsort(key, kind="stable")
    key, row = key[o], row[o]
    head = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    several = np.minimum.reduceat(row, head) != np.maximum.reduceat(row, head)
    key = key[head]
    part, low = (key >> np.uint64(32)).astype(np.int32), key.astype(np.uint32)
    cut = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
    ends = np.append(cut[1:], len(key)).tolist()
    blob = [pack_sorted(low[x:y]) for x, y in zip(cut.tolist(), ends)]
    bits = [np.packbits(several[x:y], bitorder="little").tobytes() for x, y in zip(cut.tolist(), ends)]
    return pa.RecordBatch.from_arrays([pa.array(part[cut]), pa.array([gid] * len(cut), pa.int64()), pa.array(blob, pa.binary()), pa.array(bits, pa.binary())],
                                      ["part", "gid", "blob", "several"])


def _bits(blob: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(blob, np.uint8), count=n, bitorder="little").view(bool)


def shared_keys(pdf: pd.DataFrame):
    """The sorted keys of each row of a part, and those among all of them that several documents have."""
    sets = [unpack_sorted(b) for b in pdf["blob"]]
    v = np.sort(np.concatenate(sets))
    return sets, np.unique(np.concatenate([v[1:][v[1:] == v[:-1]]] + [x[_bits(t, len(x))] for x, t in zip(sets, pdf["several"])]))


def _shared_anchors(docs: DataFrame, length: int, gram: int, total: int) -> BitTable:
    """Bit table of the anchors that several documents have."""
    part_bits = min(TABLE_BITS - 5, max(5, (total // (4 << 20)).bit_length()))  # parts of a few million anchors at most
    share = TABLE_BITS - part_bits  # a part holds a contiguous share of the table

    def run(batches):
        for b in batches:
            flat, offsets = flat_text(b.column(0))
            for group in grouped(bounded_rows(offsets, length)):
                key, row = (np.concatenate(c) for c in anchor_keys(flat, group, length, gram, part_bits))
                if len(key):
                    yield packed_keys(key, row, 0)

    def shared(key, pdf: pd.DataFrame) -> pd.DataFrame:
        _, v = shared_keys(pdf)
        bits = np.zeros(1 << share, np.uint8)
        for at in table_places(v.astype(np.int64), 32, share):
            bits[at] = 1
        return pd.DataFrame({"part": [int(key[0])], "segment": [np.packbits(bits, bitorder="little").tobytes()]})
    packed = docs.select("text").mapInArrow(run, "part int, gid long, blob binary, several binary")
    return BitTable.of_segments(packed.groupBy("part").applyInPandas(shared, "part int, segment binary"), TABLE_BITS)


def pack_group(doc: np.ndarray, tid: np.ndarray, before: np.ndarray, size: np.ndarray, texts: list[np.ndarray]) -> bytes:
    raw = b"".join([x.astype("<i8").tobytes() for x in (doc, tid, before, size)] + [x.tobytes() for x in texts])
    return np.array([len(doc), len(raw)], "<i8").tobytes() + pa.compress(raw, "zstd", asbytes=True)


def unpack_group(blob: bytes):
    """(flat text, offsets, doc, tid, bytes of the text before) of a packed group."""
    n, size = np.frombuffer(blob[:16], "<i8").tolist()
    raw = pa.decompress(blob[16:], size, "zstd", asbytes=True)
    doc, tid, before, sizes = np.frombuffer(raw, "<i8", 4 * n).reshape(4, n)
    return np.frombuffer(raw, np.uint8, offset=32 * n), np.append(0, np.cumsum(sizes)), doc, tid, before


def _text_groups(docs: DataFrame, length: int) -> DataFrame:
    """Groups of bounded rows as (gid, blob).  Their numbers hold for the written table only."""
    def run(batches):
        gid, got, held = TaskContext.get().partitionId() << 32, [], 0

        def packed():
            doc, tid, before, size, texts = zip(*got)
            return pa.RecordBatch.from_arrays([pa.array([gid], pa.int64()), pa.array([pack_group(*(np.concatenate(c) for c in (doc, tid, before, size)), texts)], pa.binary())],
                                              ["gid", "blob"])
        for b in batches:
            flat, offsets = flat_text(b.column(1))
            doc, tid = b.column(0).to_numpy(zero_copy_only=False), b.column(2).to_numpy(zero_copy_only=False)
            for x, y, inside, i, before in bounded_rows(offsets, length):
                n = len(inside) - 1
                got.append((doc[i:i + n], tid[i:i + n], np.full(n, before), np.diff(inside), flat[x:y]))
                held += y - x
                if held >= GROUP_BYTES:
                    yield packed()
                    gid, got, held = gid + 1, [], 0
        if got:
            yield packed()
    return docs.where("doc_id IS NOT NULL").mapInArrow(run, "gid long, blob binary")


def group_part_bits(total: int) -> int:
    return max(5, (total // PART_TEXT).bit_length())


def _answers(groups: DataFrame, length: int, gram: int, part_bits: int) -> DataFrame:
    """(gid, part, blob): a bit for each key that a group sent to a part, in their order, set where several documents have it."""
    def run(batches):
        for b in batches:
            for gid, blob in zip(b.column(0).to_pylist(), b.column(1)):
                flat, offsets, *_ = unpack_group(blob.as_py())
                key, row = (np.concatenate(c) for c in anchor_keys(flat, bounded_rows(offsets, length), length, gram, part_bits))
                if len(key):
                    yield packed_keys(key, row, gid)

    def answer(key, pdf: pd.DataFrame) -> pd.DataFrame:
        sets, v = shared_keys(pdf)
        bits = [v[np.minimum(np.searchsorted(v, x), len(v) - 1)] == x if len(v) else np.zeros(len(x), bool) for x in sets]
        return pd.DataFrame({"gid": pdf["gid"], "part": np.int32(key[0]), "blob": [np.packbits(x, bitorder="little").tobytes() for x in bits]})
    sent = groups.select("gid", "blob").mapInArrow(run, "part int, gid long, blob binary, several binary")
    return sent.groupBy("part").applyInPandas(answer, "gid long, part int, blob binary")


PIECE = "bucket int, id long, doc long, tid long, start int, s binary, lo long, hi long"


def group_pieces(flat: np.ndarray, group, doc: np.ndarray, tid: np.ndarray, passes: Callable, length: int, gram: int, filter_gram: int, buckets: int):
    """Pieces of a group of bounded parts as a record batch, none if it has none; ``passes(number, hashes)`` tells of
    the long anchors of the group's part of that number whether they pass."""
    found = []
    for k, (x, y, inside, i, before) in enumerate(group):
        anchors = Anchors(flat[x:y], inside, length)
        first, last, _, h, _ = anchors.of(filter_gram)
        # a window that another document holds has its long anchor there, too
        start, last, _, h, row = anchors.of(gram, np.repeat(passes(k, h), last - first + 1))
        stop = last + length
        found.append((anchors.ids(start, stop), (h % np.uint64(buckets)).astype(np.int32), row + i, start - inside[row] + np.broadcast_to(before, len(inside) - 1)[row], start + x, stop + x))
    ids, bucket, row, place, start, stop = (np.concatenate(c) for c in zip(*found))
    if not len(ids):
        return None
    d = doc[row].astype(np.int64)
    _, once, number = np.unique(ids, return_index=True, return_inverse=True)
    o = np.argsort(number, kind="stable")
    head = np.flatnonzero(np.diff(number[o], prepend=-1))
    lo, hi = np.minimum.reduceat(d[o], head), np.maximum.reduceat(d[o], head)
    other = np.ones(len(ids), bool)
    other[once] = False
    s = _strings(flat, start, np.where(other, start, stop), other)
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket), pa.array(ids), pa.array(d), pa.array(tid[row].astype(np.int64)), pa.array(place.astype(np.int32)), s,
         pa.array(lo[number], mask=other), pa.array(hi[number], mask=other)],
        ["bucket", "id", "doc", "tid", "start", "s", "lo", "hi"])


def _pieces(docs: DataFrame, bits: BitTable, length: int, gram: int, filter_gram: int, buckets: int) -> DataFrame:
    """One row per piece of windows whose long anchor passes: bucket, id, doc, tid, start; at its first place in a group of chunks also
    s and the smallest and largest doc of the group that has it."""
    shared = bits.table

    def run(batches):
        table = shared.value

        def passes(_, h):
            passing = np.ones(len(h), bool)
            for at in table_places((even(h) >> np.uint64(20)).astype(np.int64), 44, TABLE_BITS):
                passing &= BitTable.test(table, at)
            return passing
        for b in batches:
            flat, offsets = flat_text(b.column(1))
            doc, tid = b.column(0).to_numpy(zero_copy_only=False), b.column(2).to_numpy(zero_copy_only=False)
            for group in grouped(bounded_rows(offsets, length)):
                found = group_pieces(flat, group, doc, tid, passes, length, gram, filter_gram, buckets)
                if found is not None:
                    yield found
    return docs.where("doc_id IS NOT NULL").mapInArrow(run, PIECE)


def _answered_pieces(groups: DataFrame, answers: DataFrame, length: int, gram: int, filter_gram: int, part_bits: int, buckets: int) -> DataFrame:
    """The rows of ``_pieces``, from written groups and the answers of the parts."""
    def run(rows: pa.Table) -> pa.Table:
        part, blobs = rows["part"].to_numpy(), rows["blob"]
        flat, offsets, doc, tid, before = unpack_group(blobs[int(np.flatnonzero(part < 0)[0])].as_py())
        group = [(x, y, inside, i, before[i:i + len(inside) - 1] + k) for x, y, inside, i, k in bounded_rows(offsets, length)]
        keys, _ = anchor_keys(flat, group, length, filter_gram, part_bits)
        key, of = np.unique(np.concatenate(keys), return_inverse=True)
        asked, n = np.unique(key >> np.uint64(32), return_counts=True)
        told = np.argsort(part)[1:]
        if not np.array_equal(part[told], asked):
            raise RuntimeError("a part's answer is missing")
        passing = np.concatenate([_bits(blobs[k].as_py(), c) for k, c in zip(told.tolist(), n.tolist())] + [np.zeros(0, bool)])[of]
        ends = np.cumsum([len(k) for k in keys])
        found = group_pieces(flat, group, doc, tid, lambda k, h: passing[ends[k] - len(h):ends[k]], length, gram, filter_gram, buckets)
        return empty if found is None else pa.Table.from_batches([found])
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    empty = pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in PIECE.split(", ")]).empty_table()
    both = groups.select("gid", F.lit(-1).alias("part"), "blob").unionByName(answers.select("gid", "part", "blob"))
    return both.groupBy("gid").applyInArrow(run, PIECE)


def _matches(pieces: DataFrame, length: int, gram: int) -> DataFrame:
    """(bucket, id, from, to, first): runs of window offsets of a piece that first occur in document ``first``, where
    some document that has the piece comes later."""
    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        # equal pieces come once from each group of chunks that has them
        ids = pdf["id"].to_numpy()
        o = np.argsort(ids, kind="stable")
        head = np.flatnonzero(np.concatenate(([True], ids[o][1:] != ids[o][:-1])))
        lo, hi = np.minimum.reduceat(pdf["lo"].to_numpy()[o], head), np.maximum.reduceat(pdf["hi"].to_numpy()[o], head)
        pdf = pd.DataFrame({"id": ids[o[head]], "s": pdf["s"].to_numpy()[o[head]], "lo": lo, "hi": hi})
        # an anchor with one distinct piece has no other text to match: later documents lose all of it
        heads = np.frombuffer(b"".join(x[:length] for x in pdf["s"]), np.uint8)
        anchor = Anchors(heads, np.arange(len(pdf) + 1) * length, length).of(gram)[3]  # one window a piece
        alone = ~pd.Series(anchor, index=pdf.index).duplicated(keep=False)
        whole = pdf[alone & (pdf["lo"] < pdf["hi"])]
        out = pd.DataFrame({"bucket": key[0], "id": whole["id"], "from": np.int32(0), "to": (whole["s"].map(len) - length).astype(np.int32), "first": whole["lo"]})
        pdf = pdf[~alone].sort_values("lo", kind="stable")
        if not len(pdf):
            return out
        lo, hi, ids = pdf["lo"].to_numpy(), pdf["hi"].to_numpy(), pdf["id"].to_numpy()
        string, offset, first = RunLengthIndex(pdf["s"].tolist(), length).stream()
        o = np.lexsort((offset, string))
        string, offset, owner = string[o], offset[o], lo[first[o]]
        late = owner < hi[string]
        string, offset, owner = string[late], offset[late], owner[late]
        if not len(string):
            return out
        head = np.concatenate(([True], (string[1:] != string[:-1]) | (offset[1:] != offset[:-1] + 1) | (owner[1:] != owner[:-1])))
        at = np.flatnonzero(head)
        last = np.append(at[1:], len(string)) - 1
        found = pd.DataFrame({"bucket": key[0], "id": ids[string[at]], "from": offset[at].astype(np.int32), "to": offset[last].astype(np.int32), "first": owner[at]})
        return pd.concat([out, found])
    return pieces.groupBy("bucket").applyInPandas(run, "bucket int, id long, `from` int, `to` int, `first` long")


def _rows(docs: DataFrame) -> DataFrame:
    """(doc_id, text, tid): ``tid`` tells the texts of rows that repeat a doc_id apart."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.withColumn("tid", F.xxhash64("text"))


def long_matches(docs: DataFrame, length: int = 50) -> DataFrame:
    """(doc, tid, spans): the byte spans [start, stop) that go, unmerged; documents without any are absent."""
    gram, filter_gram = max(1, 2 * length // 5), max(1, 17 * length // 25)
    rows = _rows(docs)
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-total // BUCKET_BYTES))
    if total <= TABLE_TEXT:
        bits = _shared_anchors(rows.where("doc_id IS NOT NULL"), length, filter_gram, total)
        pieces = materialize(_pieces(rows, bits, length, gram, filter_gram, buckets), "suffix-pieces", compression="zstd", release=True)
    else:
        part_bits = group_part_bits(total)
        groups = materialize(_text_groups(rows, length), "suffix-text", compression="uncompressed")
        answers = materialize(_answers(groups, length, filter_gram, part_bits), "suffix-answers", compression="zstd", release=True)
        pieces = materialize(_answered_pieces(groups, answers, length, gram, filter_gram, part_bits, buckets), "suffix-pieces", compression="zstd", release=True)
        drop_table(groups)
        drop_table(answers)
    distinct = pieces.where("s IS NOT NULL").select("bucket", "id", "s", "lo", "hi")
    found = materialize(_matches(distinct, length, gram), "suffix-matches", release=True)
    hits = pieces.select("bucket", "id", "doc", "tid", "start").join(found, ["bucket", "id"]).where(F.col("first") < F.col("doc"))
    span = F.struct((F.col("start") + F.col("from")).alias("start"), (F.col("start") + F.col("to") + length).alias("stop"))
    return hits.groupBy("doc", "tid").agg(F.collect_list(span).alias("spans"))


def cut_long_matches(docs: DataFrame, length: int = 50) -> DataFrame:
    """One row per input row: doc_id, n_bytes, spans (merged byte spans that went), kept (the remaining bytes)."""
    found = materialize(long_matches(docs, length), "suffix-spans", release=True)
    at = F.shiftrightunsigned(F.xxhash64("doc", "tid"), 64 - ROW_BITS)
    shared = BitTable.of(found.select(at.alias("at")), ROW_BITS).table

    @F.pandas_udf("boolean")
    def may_lose(hashes: pd.Series) -> pd.Series:
        return pd.Series(BitTable.test(shared.value, hashes.to_numpy(np.int64)))

    # only rows that may lose something are shuffled to meet their spans
    rows = _rows(docs)
    name = F.shiftrightunsigned(F.xxhash64("doc_id", "tid"), 64 - ROW_BITS)
    whole = rows.where(F.col("doc_id").isNull() | ~may_lose(name)).select("doc_id", "text", F.expr("CAST(NULL AS array<struct<start:int,stop:int>>)").alias("spans"))
    found = found.select("doc", F.col("tid").alias("of"), "spans")
    cut = rows.where(F.col("doc_id").isNotNull() & may_lose(name)).join(found, (F.col("doc_id") == F.col("doc")) & (F.col("tid") == F.col("of")), "left")
    joined = whole.unionByName(cut.select("doc_id", "text", "spans"))
    pair = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))

    def run(batches):
        for b in (whole.slice(i, j - i) for whole in batches for i, j in row_chunks(flat_text(whole.column(1))[1])):
            sizes, merged, kept = [], [], []
            texts = b.column(1).cast(pa.binary()).to_pylist()
            for raw, spans in zip(texts, b.column(2).to_pylist()):
                sizes.append(len(raw))
                out: list[dict] = []
                for s in sorted((x["start"], x["stop"]) for x in spans or ()):
                    if out and s[0] <= out[-1]["stop"]:
                        out[-1]["stop"] = max(out[-1]["stop"], s[1])
                    else:
                        out.append({"start": s[0], "stop": s[1]})
                at, parts = 0, []
                for x in out:
                    parts.append(raw[at:x["start"]])
                    at = x["stop"]
                merged.append(out)
                kept.append(b"".join(parts) + raw[at:])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), pa.array(merged, pair), pa.array(kept, pa.binary())],
                                             ["doc_id", "n_bytes", "spans", "kept"])
    return joined.select("doc_id", "text", "spans").mapInArrow(run, "doc_id long, n_bytes long, spans array<struct<start:int,stop:int>>, kept binary")
