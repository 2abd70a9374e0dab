"""Sinks and sources for results.

Tables are written by Spark writers (partitioned by symbol where it helps
later partition pruning); JSON keeps NULL fields explicit; models use the
Spark ML writer/reader.  Nothing is gathered on the driver."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """A4: parquet sink (``partition_by=["symbol"]`` for per-symbol pruning)."""
    w = df.write.mode("overwrite")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """A5: CSV result table with a header."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines; NULLs are written (not dropped), timestamps ISO-8601."""
    df.write.mode("overwrite").option("ignoreNullFields", False) \
      .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss").json(path)


def read_json(spark: SparkSession, path: str, schema=None) -> DataFrame:
    r = spark.read
    return (r.schema(schema) if schema is not None else r).json(path)


def save_model(model: PipelineModel, path: str) -> None:
    """Spark ML persistence."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
