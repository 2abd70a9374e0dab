"""URL filters: glob rules packed into multiword Shift-And masks, run over all URLs of a batch at once.

A rule is a pair of globs, host and path, matched against the canonical URL (host in lower case, then the path).  In
globs ``*`` stands for any run of characters; a rule's host also fits all its subdomains, which is compiled as a
second pattern that starts with a run of characters other than ``/``.  Every pattern is a chain of states, one per
literal byte, laid out in 64-bit words; a run is a self-loop on the state before it.  One step per byte moves the state
sets of all URLs of a batch, whose finished rows leave it (rows are sorted by length), so long URLs cost their own
length only.  The longest fitting rule wins; ties go to the rule listed first.

Null URLs and URLs without ``://`` have an empty host and path, which no rule fits (a glob of only ``*`` does).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ripplet.llm.common import fresh_name


@dataclass(frozen=True)
class Rule:
    host: str  # '' with glob=True: the path glob is the whole pattern
    path: str
    block: bool
    glob: bool = False  # a plain glob over host + path instead of a host with subdomains and a path prefix

    @property
    def name(self) -> str:
        return self.path if self.glob else self.host + self.path


ANY, LABELS = -1, -2  # runs of any byte, and of any byte but '/'


def _patterns(rule: Rule) -> list[list[int]]:
    def glob(text: str) -> list[int]:
        return [ANY if c == ord("*") else c for c in text.encode()]
    if rule.glob:
        return [glob(rule.path)]
    tail = glob(rule.host + rule.path) + [ANY]
    return [tail, [LABELS, ord(".")] + tail]


class ShiftAnd:
    """Masks of a rule list.  State k of a pattern: its first k literals are matched; state 0 is the start."""

    def __init__(self, rules: list[Rule]):
        self.rules = rules
        chains = [(i, p) for i, r in enumerate(rules) for p in _patterns(r)]
        states = sum(1 + sum(c >= 0 for c in p) for _, p in chains)
        self.words = max(1, -(-states // 64))
        self.step = np.zeros((256, self.words), np.uint64)  # states that a byte may enter
        self.loop = np.zeros((256, self.words), np.uint64)  # states that a byte may stay in
        self.start, self.last = np.zeros(self.words, np.uint64), []
        at = 0
        for i, p in chains:
            self.start[at // 64] |= np.uint64(1 << at % 64)
            for c in p:
                bit = np.uint64(1 << at % 64)
                if c < 0:
                    stay = np.ones(256, bool)
                    stay[ord("/")] = c == ANY
                    self.loop[stay, at // 64] |= bit
                else:
                    at += 1
                    self.step[c, at // 64] |= np.uint64(1 << at % 64)
            self.last.append((i, at // 64, np.uint64(1 << at % 64)))
            at += 1

    def match(self, texts: list[bytes]) -> np.ndarray:
        """Number of the winning rule of each text, or -1."""
        n = len(texts)
        length = np.array([len(t) for t in texts], np.int64)
        order = np.argsort(-length, kind="stable")
        flat = np.frombuffer(b"".join(texts[i] for i in order), np.uint8)
        length = length[order]
        offset = np.cumsum(length) - length
        state = np.repeat(self.start[None, :], n, axis=0)
        live = n
        for k in range(int(length[0]) if n else 0):
            live = int(np.searchsorted(-length, -k, side="left"))  # rows longer than k
            byte = flat[offset[:live] + k]
            s = state[:live]
            moved = s << np.uint64(1)
            moved[:, 1:] |= s[:, :-1] >> np.uint64(63)
            state[:live] = (moved & self.step[byte]) | (s & self.loop[byte])
        best, size = np.full(n, -1), np.full(n, -1)
        for i, word, bit in self.last:
            fits = (state[:, word] & bit != 0) & (len(self.rules[i].name) > size)
            best[fits], size[fits] = i, len(self.rules[i].name)
        out = np.empty(n, np.int64)
        out[order] = best
        return out


def split_url(url):
    """(host, path) columns: the host after the first '://' up to '/', '?', '#' or the end, A-Z lower-cased; the path from
    there up to '?', '#' or the end.  Both empty without '://' or for null."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)\z", 1), F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def judge_urls(pages: DataFrame, rules: list[Rule], fallback: list[Rule], url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule (name of the longest fitting rule, else null), glob (the fallback glob that decided,
    else null) and verdict (block or allow: the rule's, else the fallback's, else allow)."""
    both = pages.sparkSession.sparkContext.broadcast((ShiftAnd(rules), ShiftAnd(fallback)))

    @F.pandas_udf("rule string, glob string, verdict string")
    def verdict(hosts: pd.Series, paths: pd.Series) -> pd.DataFrame:
        first, second = both.value
        texts = [(h + p).encode() for h, p in zip(hosts, paths)]
        a, b = first.match(texts), second.match(texts)
        b[a >= 0] = -1
        return pd.DataFrame({
            "rule": [first.rules[i].name if i >= 0 else None for i in a],
            "glob": [second.rules[i].name if i >= 0 else None for i in b],
            "verdict": ["block" if (i >= 0 and first.rules[i].block) or (i < 0 <= j and second.rules[j].block) else "allow" for i, j in zip(a, b)]})

    made = ("host", "path", "rule", "glob", "verdict")  # columns of these names are replaced
    of, judged = fresh_name(pages, "split"), fresh_name(pages, "judged")
    host, path = split_url(F.col(url).cast("string"))
    split = pages.withColumn(of, F.struct(host.alias("host"), path.alias("path")))
    return (split.withColumn(judged, verdict(F.col(of)["host"], F.col(of)["path"]))
            .select(*[c for c in pages.columns if c not in made], f"{of}.host", f"{of}.path", f"{judged}.rule", f"{judged}.glob", f"{judged}.verdict"))
