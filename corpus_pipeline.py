"""The corpus pipeline: toxicity, line dedup, SimHash near-dedup, benchmark decontamination, SentencePiece encoding.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; its result is written as Parquet
under the shared checkpoint folder and read again as the next stage's docs.  All but the last return the columns of
``documents``.  Null, empty and repeated rows follow the operators' own rules (see their modules); an empty table gives
an empty result at every stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ripplet.llm import decontam, lines, pieces, simhash, toxicity
from ripplet.llm.queries import piece_model_path
from ripplet.session import materialize
from ripplet.sources.tables import read_table

TOXIC = 0.5  # documents of this score or more go


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator rejects go; the rest stay as they are."""
    scored = toxicity.score_documents(docs, read_table(spark, sf_dir, "labels"))
    return scored.where(F.col(toxicity.score_name(docs))["score"] < TOXIC).select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier one, exactly or nearly, go; a document goes if that takes all its text."""
    kept = lines.keep_first_lines(docs)
    if "n_chars" not in docs.columns:
        return kept
    return kept.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays, the one with the smallest doc_id."""
    return simhash.keep_representatives(docs, shingle=3, max_bits=3)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return decontam.keep_clean(docs, read_table(spark, sf_dir, "benchmark"), window=10)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each remaining text."""
    coded = pieces.encode_decode(docs, piece_model_path())
    return coded.select("doc_id", F.expr("CAST(octet_length(ids) DIV 4 AS BIGINT)").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [("toxicity", drop_toxic), ("line_dedup", dedup_lines), ("simhash", dedup_documents), ("decontamination", drop_contaminated), ("sentencepiece", encode)]

#: Learned scores, MinHash, SimHash and BPE merges have no SQL form; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
