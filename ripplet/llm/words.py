"""Flat word handling shared by the counting operators: spans, exact numbering of equal words, cuts of long texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

LONG_WORD = 128  # bytes from which a word is hashed alone instead of in 8-byte columns
_MUL = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xBF58476D1CE4E5B9)
_MASKS = np.array([(1 << (8 * i)) - 1 for i in range(9)], np.uint64)


def byte_class(members: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[np.frombuffer(members, np.uint8)] = True
    return table


def word_spans(flat: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the maximal runs of word bytes."""
    inside = np.zeros(len(flat) + 2, np.int8)
    inside[1:-1] = is_word[flat]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def cut_long(blob: bytes, limit: int, is_word: np.ndarray) -> Iterator[tuple[bytes, bool]]:
    """(part, more): consecutive parts of about ``limit`` bytes that end between words; a longer word is not cut."""
    at, reach = 0, 1 << 16
    flat = np.frombuffer(blob, np.uint8)
    while len(blob) - at > limit:
        stop = at + limit
        gaps = np.flatnonzero(~is_word[flat[max(at, stop - reach):stop]])
        if len(gaps):
            cut = max(at, stop - reach) + int(gaps[-1]) + 1
        else:
            while stop < len(blob) and is_word[flat[stop:stop + reach]].all():
                stop += reach
            cut = min(len(blob), stop + int(np.argmin(is_word[flat[stop:stop + reach]])) + 1) if stop < len(blob) else len(blob)
        yield blob[at:cut], cut < len(blob)
        at = cut
    if at < len(blob) or at == 0:
        yield blob[at:], False


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * _STEP
    return h ^ (h >> np.uint64(32))


def extend_hash(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase made longer by one word."""
    return mix(h * _MUL + word)


def _columns(flat: np.ndarray) -> np.ndarray:
    """The 8 bytes that start at each place, as one number; nothing is copied but the padding."""
    padded = np.concatenate((flat, np.zeros(8, np.uint8)))
    return np.ndarray(len(flat) + 1, "<u8", padded, strides=(1,))


def hash_words(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span; the same bytes give the same hash in every task."""
    size = ends - starts
    h = size.astype(np.uint64) * _MUL
    eight = _columns(flat)
    live = np.flatnonzero(size <= LONG_WORD)
    at = 0
    while len(live):
        left = size[live] - at
        h[live] = mix(h[live] * _MUL + (eight[starts[live] + at] & _MASKS[np.minimum(left, 8)]))
        live, at = live[left > 8], at + 8
    for i in np.flatnonzero(size > LONG_WORD).tolist():
        h[i] = xxhash.xxh64_intdigest(flat[starts[i]:ends[i]].tobytes(), 7)
    return h


def same_words(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray, other: np.ndarray) -> bool:
    """Whether each span i holds the same bytes as span ``other[i]``."""
    size = ends - starts
    if not np.array_equal(size, size[other]):
        return False
    live = np.flatnonzero((other != np.arange(len(size))) & (size <= LONG_WORD))
    eight, at = _columns(flat), 0
    while len(live):
        left = size[live] - at
        mask = _MASKS[np.minimum(left, 8)]
        if not np.array_equal(eight[starts[live] + at] & mask, eight[starts[other[live]] + at] & mask):
            return False
        live, at = live[left > 8], at + 8
    return all(np.array_equal(flat[starts[i]:ends[i]], flat[starts[j]:ends[j]])
               for i, j in ((i, int(other[i])) for i in np.flatnonzero(size > LONG_WORD).tolist()) if i != j)


def number_words(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """(number of each span, distinct words by number, their hashes).  Numbers come from hashes and are verified byte by
    byte; should two words ever share a hash, the spans are numbered by their bytes instead."""
    h = hash_words(flat, starts, ends)
    _, first, number = np.unique(h, return_index=True, return_inverse=True)
    blob = flat.tobytes()
    if not same_words(flat, starts, ends, first[number]):
        seen: dict[bytes, int] = {}
        number = np.array([seen.setdefault(blob[s:e], len(seen)) for s, e in zip(starts.tolist(), ends.tolist())], np.int64)
        first = np.unique(number, return_index=True)[1]
    words = [blob[s:e] for s, e in zip(starts[first].tolist(), ends[first].tolist())]
    return number, words, h[first]
