"""Registered queries of the package: each applies one operator to its whole table with production parameters."""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ripplet.llm import decontam, exact, lines, neighbours, pages, phrases, resample, secrets, simhash, suffix, toxicity, urls
from ripplet.sources.tables import read_table

REGISTRY: dict = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def piece_model_path() -> str:
    """Place of the public BPE model; the vocabulary files are a parameter, never part of this repository."""
    if "/opt" not in sys.path:
        sys.path.append("/opt")
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("long").cast("string")) % 5 == 0, F.lit(False))


@register("op1_line_dedup")
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.dedup_lines(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", F.array_join("removed", ",").alias("removed"))


@register("op2_html_text")
def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.main_text(read_table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


@register("op3_toxicity")
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    scored = toxicity.score_documents(docs.select("doc_id", "text"), labels)
    return scored.select("doc_id", held_out().alias("held_out"), F.col("toxicity.score").alias("score"),
                         (F.col("toxicity.score") >= 0.5).cast("int").alias("predicted"), F.size("toxicity.passages").alias("n_passages"))


@register("op4_suffix_dedup")
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix.cut_long_matches(read_table(spark, sf_dir, "documents"), length=50)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["stop"] - x["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@register("op5_simhash")
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_dedup(read_table(spark, sf_dir, "documents"), shingle=3, max_bits=3)


def _of_kind(kind: str):
    return lambda s: s["kind"] == kind


@register("op6_secrets", secrets.secrets_sql())
def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [F.size(F.filter("secrets", _of_kind(n[2:]))).cast("long").alias(n) for n in ("n_assign", "n_access", "n_hex")]
    base = secrets.listed(F.filter("secrets", lambda s: s["ord"] < 3))
    return found.select("doc_id", *counts, F.sha2(base.cast("binary"), 256).alias("base_sha256"), secrets.listed(F.col("secrets")).alias("spans"))


URL_RULES = [urls.Rule("com", "/", False), urls.Rule("example.com", "/en/", True), urls.Rule("www.example.com", "/en/", False),
             urls.Rule("net", "/es/", True), urls.Rule("net", "/fr/", True)]
URL_GLOBS = [urls.Rule("", g, True, True) for g in ("*casino*", "*spam-farm*", "*.example.org/*/1*.html", "*viagra*", "*/login*", "*porn*")]

OP7_SQL = """
WITH r AS (SELECT page_id, regexp_extract(coalesce(url, ''), '^(?s:.*?)://((?s:.*))$', 1) AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
f AS (SELECT *, host || path AS canon, CASE
  WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
  WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
  WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
  WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
  WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/' END AS rule FROM h)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
       WHEN canon LIKE '%casino%' OR canon LIKE '%spam-farm%' OR canon LIKE '%.example.org/%/1%.html' OR canon LIKE '%viagra%'
         OR canon LIKE '%/login%' OR canon LIKE '%porn%' THEN 'block' ELSE 'allow' END AS verdict
FROM f"""


@register("op7_url_filter", OP7_SQL)
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (urls.judge_urls(read_table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES, URL_GLOBS)
            .select("page_id", "host", "path", "rule", "verdict"))


@register("op8_nearest_neighbours")
def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest_neighbours(read_table(spark, sf_dir, "embeddings"), F.expr("vec_id % 50 = 0"), k=5)


OP9_SQL = r"""
WITH words AS (
  SELECT doc_id, unnest(range(len(w))) AS pos, w FROM (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents)),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
spots AS (SELECT item_id, w, unnest(range(greatest(len(w) - 9, 1))) AS pos FROM items WHERE len(w) > 0),
wins AS (SELECT DISTINCT item_id, list_slice(w, pos + 1, least(pos + 10, len(w))) AS win FROM spots),
firsts AS (SELECT DISTINCT win[1] AS w1, win[2] AS w2, len(win) AS size FROM wins),
cand AS (SELECT doc_id, pos, size, list_slice(w, pos + 1, pos + size) AS win FROM words
         JOIN firsts ON w[pos + 1] = w1 AND (size = 1 OR w[pos + 2] = w2) WHERE pos + size <= len(w)),
occ AS (SELECT doc_id, pos, size, item_id FROM cand JOIN wins USING (win)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS p FROM occ) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS names
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM occ) GROUP BY doc_id),
cnt AS (SELECT doc_id, count(*) AS n_words FROM words GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM documents d LEFT JOIN cnt USING (doc_id) LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)"""


@register("op9_decontamination", OP9_SQL)
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.find_windows(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), window=10)
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda a, x: a + x["stop"] - x["start"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


@register("op10_sentencepiece")
def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ripplet.llm import pieces
    coded = pieces.encode_decode(read_table(spark, sf_dir, "documents"), piece_model_path())
    return coded.select("doc_id", F.expr("CAST(octet_length(ids) DIV 4 AS BIGINT)").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


OP11_SQL = r"""
WITH rule AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, step: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS tab),
own AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
aim AS (SELECT unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark),
occ AS (SELECT rid, word, count(*) AS c FROM (SELECT rid, unnest(w) AS word FROM own) GROUP BY rid, word),
vocab AS (SELECT word, list_transform(range(octet_length(encode(word))), lambda i: CAST('0x' || substr(hex(encode(word)), 2 * i + 1, 2) AS BIGINT)) AS b
          FROM (SELECT word FROM occ UNION SELECT word FROM aim)),
bk AS (SELECT word, xor(4294967295, list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1]))) % 10000 AS bucket FROM vocab, rule),
s AS (SELECT bucket, sum(c) AS s FROM occ JOIN bk USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM aim JOIN bk USING (word) GROUP BY bucket),
tot AS (SELECT CAST(coalesce((SELECT sum(s) FROM s), 0) AS DOUBLE) AS bs, CAST(coalesce((SELECT sum(t) FROM t), 0) AS DOUBLE) AS bt),
gain AS (SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1e0) * (bs + 10000) / ((coalesce(s, 0) + 1e0) * (bt + 10000)))) AS BIGINT) AS g
         FROM (SELECT DISTINCT bucket FROM bk) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket) CROSS JOIN tot),
wt AS (SELECT rid, sum(c) AS n, sum(c * g) AS total FROM occ JOIN bk USING (word) JOIN gain USING (bucket) GROUP BY rid),
sc AS (SELECT own.rid, doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_features,
              CAST(coalesce((total - ((total % n) + n) % n) // n, 0) AS BIGINT) AS weight,
              CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h FROM own LEFT JOIN wt USING (rid)),
full_score AS (SELECT *, weight + CAST(floor(-1000e0 * ln(-ln((h + 5e-1) / 4294967296e0))) AS BIGINT) AS score FROM sc),
ranked AS (SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features) AS place, count(*) OVER () AS able FROM full_score WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * able // 100 THEN place END AS rank FROM full_score LEFT JOIN ranked USING (rid)"""


@register("op11_importance_resample", OP11_SQL)
def op11_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample.importance_resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"),
                                         longest=1, buckets=10_000, least_words=20, percent=10, seed=2024)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


OP12_SQL = r"""
WITH texts AS (SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
pieces AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM texts),
spots AS (SELECT lang, w, k, unnest(range(len(w) - k + 1)) AS i FROM pieces, (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k),
f AS (SELECT lang, k, array_to_string(list_slice(w, i + 1, i + k), ' ') AS phrase, count(*) AS f FROM spots GROUP BY ALL),
tot AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT * FROM f WHERE k >= 2 AND f >= 100),
kept AS (SELECT * FROM cand c WHERE NOT EXISTS (SELECT 1 FROM cand d WHERE d.lang = c.lang AND d.k > c.k
         AND contains(' ' || d.phrase || ' ', ' ' || c.phrase || ' ') AND 100 * d.f >= 100 * c.f)),
cuts AS (SELECT lang, k, phrase, f AS a, unnest(range(1, k)) AS cut, string_split(phrase, ' ') AS w FROM kept),
scored AS (SELECT c.lang, c.phrase, a, cut, l.f AS l, r.f AS r, n, (CAST(1000 AS HUGEINT) * a * n) // (CAST(l.f AS HUGEINT) * r.f) AS score
           FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(list_slice(w, 1, cut), ' ') AND l.k = cut
           JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(list_slice(w, cut + 1, c.k), ' ') AND r.k = c.k - cut JOIN tot ON tot.lang = c.lang),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS pick FROM scored) WHERE pick = 1)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best) WHERE rank <= 2000"""


@register("op12_collocations", OP12_SQL)
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read_table(spark, sf_dir, "documents"), longest=5, least=100, inside_percent=100, top=2000)


OP13_SQL = r"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents),
g AS (SELECT *, min(doc_id) OVER (PARTITION BY body) AS keep_id, count(*) OVER (PARTITION BY body) AS group_size,
             row_number() OVER (PARTITION BY body ORDER BY doc_id NULLS LAST, rid) AS place FROM t)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(body) AS text_sha256 FROM g"""


@register("op13_exact_dedup", OP13_SQL)
def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(read_table(spark, sf_dir, "documents"))
