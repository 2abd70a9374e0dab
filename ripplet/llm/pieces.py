"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

The model file is read once on the driver (its vocabulary bounds what is broadcast).  A text is split where no piece
can cross (before a space mark that follows another character); each distinct segment of a batch becomes a run of
symbols in one flat numpy array.  A round looks up every adjacent pair's rank, takes the smallest rank of each segment,
merges its non-overlapping occurrences from the left, and compacts the array; segments without a pair leave it.
Merging all occurrences at once equals the one-by-one order unless a longer piece that starts or ends with the merged
one ranks at least as high; for such pieces only the leftmost occurrence is merged in a round, so the result is exact.

Null and empty texts encode to the begin and end ids alone.  Extra columns are not read; repeated rows are encoded
each; doc_id may be null.  Very long texts and very long segments only lengthen the flat arrays.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
_SEGMENT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_NONE = np.iinfo(np.int32).max
CACHE_ENTRIES = 300_000  # distinct segments a worker remembers between batches
FRESH_CHARS = 1 << 20


@dataclass
class PieceModel:
    """Vocabulary of a byte-fallback BPE model without user-defined symbols and with the identity normaliser."""

    pieces: list[str]
    kinds: np.ndarray  # 0 normal, 1 control, 2 unknown, 3 byte
    scores: np.ndarray
    bos: int
    eos: int

    @staticmethod
    def load(path: str) -> PieceModel:
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        ids = range(n)
        kinds = np.array([1 if sp.is_control(i) else 2 if sp.is_unknown(i) else 3 if sp.is_byte(i) else 0 for i in ids], np.int8)
        if any(sp.is_unused(i) for i in ids) or (kinds == 3).sum() != 256:
            raise ValueError("the model must have byte fallback and no unused pieces")
        return PieceModel([sp.id_to_piece(i) for i in ids], kinds, np.array([sp.get_score(i) for i in ids]), sp.bos_id(), sp.eos_id())


class PieceCodec:
    """Tables made from the model, held once in each Python worker."""

    def __init__(self, model: PieceModel):
        self.bos, self.eos, self.kinds = model.bos, model.eos, model.kinds
        normal = {p: i for i, p in enumerate(model.pieces) if model.kinds[i] == 0}
        if any(SPACE in p.lstrip(SPACE) for p in normal):
            raise ValueError("a piece crosses a space mark")
        n = len(model.pieces)
        symbol = dict(normal)
        for p in normal:
            for c in p:
                symbol.setdefault(c, n + len(symbol))
        order = np.unique(-model.scores[list(normal.values())])
        rank = {p: int(np.searchsorted(order, -model.scores[i])) for p, i in normal.items()}
        shared = np.bincount(list(rank.values()), minlength=len(order)) > 1
        risky = {p for p in normal if shared[rank[p]]}
        keys, outs = [], []
        for q in normal:
            for k in range(1, len(q)):
                a, b = q[:k], q[k:]
                risky.update(x for x in (a, b) if x in rank and rank[q] <= rank[x])
                if a in symbol and b in symbol:
                    keys.append((symbol[a], symbol[b]))
                    outs.append(q)
        self.radix = max(symbol.values()) + 1 + 0x110000
        self.n_bits = 20
        self._hash_table(np.array([a * self.radix + b for a, b in keys], np.int64), np.array([normal[q] for q in outs], np.int32),
                         np.array([rank[q] for q in outs], np.int32))
        self.risky = np.zeros(len(order), bool)
        self.risky[[rank[p] for p in risky]] = True
        self.char = np.arange(0x110000, dtype=np.int64) + (self.radix - 0x110000)
        for c, s in symbol.items():
            if len(c) == 1:
                self.char[ord(c)] = s
        self.n = n
        self.byte_id = np.zeros(256, np.uint32)
        for i, p in enumerate(model.pieces):
            if model.kinds[i] == 3:
                self.byte_id[int(p[3:5], 16)] = i
        self.spell = {s: c for c, s in symbol.items() if s >= n}
        unk = " ⁇ ".encode()
        self.out = [b"" if k == 1 else unk if k == 2 else bytes([int(p[3:5], 16)]) if k == 3 else p.replace(SPACE, " ").encode()
                    for p, k in zip(model.pieces, model.kinds)]
        self.lead = np.array([k == 0 and p.startswith(SPACE) for p, k in zip(model.pieces, model.kinds)])
        self.word_cache: dict[str, bytes] = {}
        self.segment_cache: dict[str, bytes] = {}

    def _hash_table(self, keys, outs, ranks):
        size = 1 << self.n_bits
        self.slot_key = np.full(size, -1, np.int64)
        self.slot_out, self.slot_rank = np.zeros(size, np.int32), np.full(size, _NONE, np.int32)
        at, todo, self.probes = self._slot(keys), np.arange(len(keys)), 0
        while len(todo):
            self.probes += 1
            _, first = np.unique(at[todo], return_index=True)
            put = todo[first][self.slot_key[at[todo[first]]] < 0]
            self.slot_key[at[put]], self.slot_out[at[put]], self.slot_rank[at[put]] = keys[put], outs[put], ranks[put]
            todo = np.setdiff1d(todo, put)
            at[todo] = (at[todo] + 1) & (size - 1)

    def _slot(self, keys):
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.n_bits)).astype(np.int64)

    def _lookup(self, left, right):
        """(rank, piece) of each adjacent pair; rank _NONE where the vocabulary has no such piece."""
        key = left * self.radix + right
        at = self._slot(key)
        rank, out = np.full(len(key), _NONE, np.int32), np.zeros(len(key), np.int32)
        todo = np.arange(len(key))
        for _ in range(self.probes):
            found = self.slot_key[at]
            hit = found == key[todo]
            rank[todo[hit]], out[todo[hit]] = self.slot_rank[at[hit]], self.slot_out[at[hit]]
            go = ~hit & (found >= 0)
            if not go.any():
                break
            todo, at = todo[go], (at[go] + 1) & (len(self.slot_key) - 1)
        return rank, out

    def merge(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(symbols, segment numbers) of the (non-empty) segments after the last round, in text order."""
        cps = np.frombuffer("".join(segments).encode("utf-32-le", "surrogatepass"), np.uint32)
        sym = self.char[cps]
        word = np.repeat(np.arange(len(segments)), [len(s) for s in segments])
        done_sym, done_word = [], []
        while len(sym):
            rank, out = self._lookup(sym[:-1], sym[1:])
            inside = word[:-1] == word[1:]
            rank = np.append(np.where(inside, rank, _NONE), _NONE)
            out = np.append(out, 0)
            start = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            length = np.diff(np.append(start, len(sym)))
            low = np.minimum.reduceat(rank, start)
            open_ = low < _NONE
            here = (rank == np.repeat(low, length)) & (rank < _NONE)
            pos = np.flatnonzero(here)
            if len(pos):
                # within a run of overlapping candidates, every other one from the left
                head = np.concatenate(([True], pos[1:] != pos[:-1] + 1))
                run = np.maximum.accumulate(np.where(head, np.arange(len(pos)), 0))
                take = (np.arange(len(pos)) - run) % 2 == 0
                first = np.concatenate(([True], word[pos[1:]] != word[pos[:-1]]))
                take &= first | ~self.risky[rank[pos]]
                pos = pos[take]
                sym[pos] = out[pos]
            keep = np.ones(len(sym), bool)
            keep[pos + 1] = False
            live = np.repeat(open_, length)
            ended = keep & ~live
            done_sym.append(sym[ended])
            done_word.append(word[ended])
            keep &= live
            sym, word = sym[keep], word[keep]
        s, w = np.concatenate(done_sym), np.concatenate(done_word)
        o = np.argsort(w, kind="stable")
        return s[o], w[o]

    def _encode_segments(self, segments: list[str]) -> list[bytes]:
        """Ids of each segment as bytes; a symbol outside the vocabulary becomes the ids of its UTF-8 bytes."""
        s, w = self.merge(segments)
        odd = np.flatnonzero(s >= self.n)
        if len(odd):
            cp = s[odd] - (self.radix - 0x110000)
            cp[cp < 0] = [ord(self.spell[x]) for x in s[odd][cp < 0].tolist()]
            more = (cp >= 0x80).astype(np.int64) + (cp >= 0x800) + (cp >= 0x10000)
            size = np.ones(len(s), np.int64)
            size[odd] += more
            at = (np.cumsum(size) - size)[odd]
            s, w = np.repeat(s, size), np.repeat(w, size)
            lead = np.array([0, 0xC0, 0xE0, 0xF0])[more] | (cp >> (6 * more))
            s[at] = self.byte_id[lead]
            for k in range(1, 4):
                has = more >= k
                s[at[has] + k] = self.byte_id[0x80 | ((cp[has] >> (6 * (more[has] - k))) & 0x3F)]
        flat = s.astype("<u4").tobytes()
        cut = (4 * np.searchsorted(w, np.arange(len(segments) + 1))).tolist()
        return [flat[i:j] for i, j in zip(cut, cut[1:])]

    def _fill(self, cache: dict[str, bytes], fresh: set[str], prefix: str) -> None:
        todo, i = list(fresh), 0
        while i < len(todo):
            j, chars = i, 0
            while j < len(todo) and (j == i or chars < FRESH_CHARS):
                chars += len(todo[j]) + 1
                j += 1
            cache.update(zip(todo[i:j], self._encode_segments([prefix + x for x in todo[i:j]])))
            i = j

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text, begin and end ids included, as little-endian unsigned 32-bit integers."""
        begin, end = np.uint32(self.bos).tobytes(), np.uint32(self.eos).tobytes()
        split = []
        for t in texts:
            if not t:
                split.append((None, []))
            elif "  " in t or t[0] == " " or SPACE in t:
                split.append((self.segment_cache, _SEGMENT.findall(SPACE + t.replace(" ", SPACE))))
            else:
                split.append((self.word_cache, t.split(" ")))
        for cache, prefix in ((self.word_cache, SPACE), (self.segment_cache, "")):
            if len(cache) > CACHE_ENTRIES:
                cache.clear()
            fresh: set[str] = set()
            for c, parts in split:
                if c is cache:
                    fresh.update(parts)
            fresh.difference_update(cache)
            self._fill(cache, fresh, prefix)
        return [begin + b"".join(map(c.__getitem__, parts)) + end if parts else begin + end for c, parts in split]

    def decode(self, ids: np.ndarray) -> str:
        """The text of a sequence of ids: control ids vanish, the first space mark of the text is the dummy prefix,
        runs of byte ids are UTF-8 (bytes that are no valid sequence become U+FFFD, one each)."""
        text = [self.out[i] for i in ids.tolist()]
        shown = np.flatnonzero(self.kinds[ids] != 1)
        if len(shown) and self.lead[ids[shown[0]]]:
            text[shown[0]] = text[shown[0]][1:]
        whole = b"".join(text)
        try:
            return whole.decode()
        except UnicodeDecodeError:
            return _decode_bytewise(whole)


def _decode_bytewise(raw: bytes) -> str:
    parts, i = [], 0
    while i < len(raw):
        n = 1 if raw[i] < 0x80 else 2 if 0xC2 <= raw[i] < 0xE0 else 3 if 0xE0 <= raw[i] < 0xF0 else 4 if 0xF0 <= raw[i] < 0xF5 else 0
        try:
            parts.append(raw[i:i + n].decode() if n else "�")
            i += n or 1
        except UnicodeDecodeError:
            parts.append("�")
            i += 1
    return "".join(parts)


_CODECS: dict[str, PieceCodec] = {}


def encode_decode(docs: DataFrame, model_path: str, batch_chars: int = 1 << 20) -> DataFrame:
    """(doc_id, ids binary: little-endian unsigned 32-bit, decoded string) of every row."""
    model = docs.sparkSession.sparkContext.broadcast(PieceModel.load(model_path))

    def run(batches):
        codec = _CODECS.get(model_path)
        if codec is None:
            codec = _CODECS[model_path] = PieceCodec(model.value)
        for b in batches:
            i = 0
            while i < len(b):
                j, chars = i, 0
                while j < len(b) and (j == i or chars < batch_chars):
                    chars += len(b.column(1)[j].as_py() or "")
                    j += 1
                texts = b.column(1).slice(i, j - i).to_pylist()
                ids = codec.encode_batch(texts)
                decoded = [codec.decode(np.frombuffer(x, "<u4")) for x in ids]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(ids, pa.binary()), pa.array(decoded, pa.string())],
                                                 ["doc_id", "ids", "decoded"])
                i = j
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, ids binary, decoded string")
