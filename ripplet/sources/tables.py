"""Reading the driver's parquet tables (one file per table)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def stream_table(spark: SparkSession, path: str, schema, max_files_per_trigger: int = 1) -> DataFrame:
    """The table at ``path`` (one file, or a directory of part files) as a stream of its files.  A file source takes a
    directory or a pattern, so the name is written as a pattern that fits nothing else."""
    head, name = os.path.split(path.rstrip("/"))
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
                 .parquet(os.path.join(head, f"[{name[0]}]{name[1:]}")))
