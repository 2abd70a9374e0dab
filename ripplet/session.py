"""Session helpers: sane defaults for local runs and a shared checkpoint root.

On a cluster the checkpoint root comes from ``spark.checkpoint.dir`` (a shared
filesystem the cluster names).  Only when that is unset *and* the master is
local (tests, bench) do we create a private scratch folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Per-symbol windows sort bars, never raw ticks; keep a modest target size.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
    # Bar-level window stages are CPU-bound (rows x frame length), not byte-bound:
    # do not coalesce small post-shuffle partitions into one task.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k",
    "spark.sql.files.maxPartitionBytes": "128m",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "ripplet", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
        if master.startswith("local"):
            # Local mode: the driver JVM is the only executor; size its heap.
            b = b.config("spark.driver.memory", "12g")
    for k, v in _DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts: ``spark.checkpoint.dir`` if set.

    Falls back to a private scratch folder only in local mode."""
    d = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not _is_local(spark):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="ripplet-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None, compression: str | None = None,
                release: bool = False) -> DataFrame:
    """Write ``df`` as parquet under the checkpoint root and read it back.

    Cuts lineage (so a lost executor recomputes from the written table, not
    from the raw scan) and gives later stages column pruning + pushdown.
    ``release`` removes the run's shuffle files once the table is written,
    not whenever the driver happens to collect its garbage."""
    spark = df.sparkSession
    root = checkpoint_root(spark)
    path = os.path.join(root, "tables", f"{name}-{uuid.uuid4().hex[:12]}")
    w = df.write.mode("overwrite")
    if compression:
        w = w.option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    kept = spark.conf.get(_RELEASE, "false")
    if release:
        spark.conf.set(_RELEASE, "true")
    try:
        w.parquet(path)
    finally:
        if release:
            spark.conf.set(_RELEASE, kept)
    return spark.read.parquet(path)


def drop_table(df: DataFrame) -> None:
    """Remove a table that ``materialize`` wrote and that nothing reads any more."""
    sc = df.sparkSession.sparkContext
    for folder in {os.path.dirname(f) for f in df.inputFiles()}:
        path = sc._jvm.org.apache.hadoop.fs.Path(sc._jvm.java.net.URI(folder))
        if path.getParent().getName() != "tables":
            raise ValueError(f"{folder} is no table of materialize()")
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
