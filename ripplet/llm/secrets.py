"""Secret scans with DataFrame functions only: fixed patterns, and sliding-window entropy over candidate strings.

Every match is found by marking it in the text with a private-use character (which is first replaced in the text by
another one, so that offsets hold), splitting there, and adding up the code points of the pieces.

The entropy classes look at candidate strings (maximal runs of the class alphabet that hold a digit).  A window of
fixed width slides over the candidate; its symbol counts are kept incrementally (one symbol enters, one leaves), with
the running sum of c*log2(c) in millionths, so that Shannon entropy H = log2(width) - sum / width needs no recount and
no floating-point sum.  Windows of at least the class's entropy are joined where they touch; candidates on the allow
list (examples, sequences, UUIDs, content digests) are suppressed.  Fixed-pattern spans are never suppressed.

Null and empty texts have no span.  Spans of one kind never overlap; rows are handled one by one, so repeated rows,
null doc_ids and extra columns need no rule, and there is no shuffle.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARK, STAND_IN = "\ue000", "\ue001"
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS, HEX = r"AKIA[A-Z0-9]{16,}", r"[0-9a-f]{24,}"  # greedy runs: the shorter ones that the length rule drops never match
ALLOW = (r"(?i)example|placeholder|changeme|redacted|0123456789|abcdefghij|^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$|"
         r"^sha(1|256|384|512)-")
SPAN = "array<struct<start:int,ord:int,stop:int,kind:string>>"


@dataclass(frozen=True)
class EntropyClass:
    kind: str
    pattern: str
    alphabet: str
    width: int
    bits: float

    @property
    def table(self) -> list[int]:
        """round(10^6 c log2 c) for c = 0..width."""
        return [0] + [round(1e6 * c * math.log2(c)) for c in range(1, self.width + 1)]

    @property
    def limit(self) -> int:
        """Largest sum of the table's values whose window has the entropy asked for."""
        return math.floor(1e6 * self.width * (math.log2(self.width) - self.bits))


_DIGITS, _UPPER, _LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CLASSES = (EntropyClass("entropy_hex", r"[0-9A-Fa-f]{32,}", _DIGITS + "ABCDEFabcdef", 32, 3.0),
           EntropyClass("entropy_token", r"[A-Za-z0-9+/_=-]{20,}", _DIGITS + _UPPER + _LOWER + "+/_=-", 20, 3.7))


def _spans(text: Column, pattern: str, order: int, kind: str, keep=None, body=None) -> Column:
    """Spans of the kept matches of ``pattern``; ``body`` (match, start) -> spans replaces a match's own span."""
    parts = F.split(F.regexp_replace(text, pattern, MARK + "$0" + MARK), MARK, -1)

    def own(x, pos):
        return F.array(F.struct(pos.alias("start"), F.lit(order).alias("ord"), (pos + F.length(x)).alias("stop"), F.lit(kind).alias("kind")))

    def step(acc, x):
        found = (body or own)(x, acc["pos"])
        wanted = acc["odd"] if keep is None else acc["odd"] & keep(x)
        return F.struct((acc["pos"] + F.length(x)).alias("pos"), (~acc["odd"]).alias("odd"),
                        F.when(wanted, F.concat(acc["out"], found)).otherwise(acc["out"]).alias("out"))

    start = F.struct(F.lit(0).alias("pos"), F.lit(False).alias("odd"), F.expr(f"CAST(array() AS {SPAN})").alias("out"))
    return F.aggregate(parts, start, step, lambda acc: acc["out"])


def _entropy_spans(cls: EntropyClass, order: int):
    """(candidate, start) -> spans of its windows with at least the class's entropy."""
    table = F.array(*[F.lit(v).cast("long") for v in cls.table])
    w, size = cls.width, len(cls.alphabet)

    def spans(s, pos):
        code = F.transform(F.filter(F.split(s, ""), lambda ch: ch != ""), lambda ch: F.instr(F.lit(cls.alphabet), ch))
        steps = F.zip_with(code, F.concat(F.array_repeat(F.lit(0), w), F.slice(code, 1, F.greatest(F.size(code) - w, F.lit(0)))),
                           lambda e, x: F.struct(e.alias("e"), x.alias("x")))

        def grown(acc):
            """The spans after judging the window that ends at acc.i."""
            first, out = pos + acc["i"] - w, acc["out"]
            last = F.try_element_at(out, F.lit(-1))
            span = lambda a: F.array(F.struct(a.alias("start"), F.lit(order).alias("ord"), (pos + acc["i"]).alias("stop"), F.lit(cls.kind).alias("kind")))
            return (F.when((acc["i"] < w) | (acc["sum"] > cls.limit), out)
                    .when(last["stop"] >= first, F.concat(F.slice(out, 1, F.size(out) - 1), span(last["start"])))
                    .otherwise(F.concat(out, span(first))))

        def step(acc, x):
            n = acc["n"]
            enters = F.element_at(n, x["e"])
            leaves = F.when(x["x"] > 0, F.element_at(n, F.greatest(x["x"], F.lit(1))) + (x["x"] == x["e"]).cast("int")).otherwise(F.lit(0))
            gain = F.element_at(table, enters + 2) - F.element_at(table, enters + 1)
            loss = F.element_at(table, leaves + 1) - F.element_at(table, F.greatest(leaves, F.lit(1)))
            counts = F.transform(n, lambda v, k: v + (k + 1 == x["e"]).cast("int") - (k + 1 == x["x"]).cast("int"))
            return F.struct((acc["i"] + 1).alias("i"), counts.alias("n"), (acc["sum"] + gain - loss).alias("sum"), grown(acc).alias("out"))

        start = F.struct(F.lit(0).alias("i"), F.array_repeat(F.lit(0), size).alias("n"), F.lit(0).cast("long").alias("sum"),
                         F.expr(f"CAST(array() AS {SPAN})").alias("out"))
        return F.aggregate(steps, start, step, grown)

    return spans


def find_secrets(docs: DataFrame, text: str = "text", classes=CLASSES, allow: str = ALLOW) -> DataFrame:
    """``docs`` with ``secrets``: spans (start, ord, stop, kind) in code points, by start, then kind as listed."""
    t = F.replace(F.coalesce(F.col(text).cast("string"), F.lit("")), F.lit(MARK), F.lit(STAND_IN))
    found = [_spans(t, ASSIGN, 0, "assign", lambda x: F.length(F.regexp_extract(x, ASSIGN, 1)) >= 6),
             _spans(t, ACCESS, 1, "access"), _spans(t, HEX, 2, "hex")]
    for k, c in enumerate(classes):
        found.append(_spans(t, c.pattern, 3 + k, c.kind, lambda x: F.rlike(x, F.lit("[0-9]")) & ~F.rlike(x, F.lit(allow)), _entropy_spans(c, 3 + k)))
    return docs.withColumn("secrets", F.array_sort(F.concat(*found)))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def entropy_sql(cls: EntropyClass, order: int) -> str:
    """DuckDB CTE body: the spans (doc_id, start, ord, stop, kind) of an entropy class over CTE ``t`` (rid, doc_id, text)."""
    table = "[" + ", ".join(map(str, cls.table)) + "]"
    w = cls.width
    return f"""
  SELECT rid, min(first) AS start, {order} AS ord, max(first) + {w} AS stop, '{cls.kind}' AS kind FROM (
    SELECT *, sum(fresh) OVER (PARTITION BY rid, pos ORDER BY first) AS island FROM (
      SELECT *, CASE WHEN first <= lag(first) OVER (PARTITION BY rid, pos ORDER BY first) + {w} THEN 0 ELSE 1 END AS fresh FROM (
        SELECT rid, pos, pos + k AS first, list_sum(list_transform(list_distinct(string_split(win, '')),
                 lambda ch: ({table})[1 + len(win) - len(replace(win, ch, ''))])) AS total FROM (
          SELECT rid, pos, k, substr(s, CAST(k + 1 AS BIGINT), {w}) AS win FROM (
            SELECT rid, pos, s, unnest(range(len(s) - {w - 1})) AS k FROM ({matches_sql(cls.pattern)})
            WHERE regexp_matches(s, '[0-9]') AND NOT regexp_matches(s, '{ALLOW}'))))
      WHERE total <= {cls.limit}))
  GROUP BY rid, pos, island"""


def matches_sql(pattern: str) -> str:
    """DuckDB: every match (rid, pos, s) of a pattern over CTE ``t``."""
    quoted = pattern.replace("'", "''")
    return f"""
  SELECT rid, CAST(list_sum(list_transform(p[1:2 * j - 1], lambda x: len(x))) AS BIGINT) AS pos, p[2 * j] AS s FROM (
    SELECT rid, p, unnest(range(1, len(p) // 2 + 1)) AS j FROM (
      SELECT rid, string_split(regexp_replace(text, '{quoted}', '{MARK}\\0{MARK}', 'g'), '{MARK}') AS p FROM t))"""


def secrets_sql() -> str:
    assign = ASSIGN.replace("'", "''")
    kinds = [f"SELECT rid, pos AS start, 0 AS ord, pos + len(s) AS stop, 'assign' AS kind FROM ({matches_sql(ASSIGN)}) WHERE len(regexp_extract(s, '{assign}', 1)) >= 6",
             f"SELECT rid, pos, 1, pos + len(s), 'access' FROM ({matches_sql(ACCESS)})",
             f"SELECT rid, pos, 2, pos + len(s), 'hex' FROM ({matches_sql(HEX)})",
             *[entropy_sql(c, 3 + k) for k, c in enumerate(CLASSES)]]
    return f"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, replace(coalesce(text, ''), '{MARK}', '{STAND_IN}') AS text FROM documents),
spans AS ({' UNION ALL '.join(kinds)}),
g AS (SELECT rid, count(*) FILTER (WHERE ord = 0) AS a, count(*) FILTER (WHERE ord = 1) AS k, count(*) FILTER (WHERE ord = 2) AS h,
             string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, ord) FILTER (WHERE ord < 3) AS base,
             string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, ord) AS every FROM spans GROUP BY rid)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(k, 0) AS n_access, coalesce(h, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(every, '') AS spans FROM t LEFT JOIN g USING (rid)"""
