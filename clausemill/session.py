"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings the jobs are designed for. All of them can be changed on a live session.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A batch of whole exhibits is bounded by bytes; 10,000 exhibits could be gigabytes.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    "spark.sql.execution.arrow.maxBytesPerBatch": "33554432",
    # "First k per group" is cut on the map side for every k (the largest int), not only below 1,000.
    "spark.sql.optimizer.windowGroupLimitThreshold": "2147483647",
    # Lists of chosen keys are looked up in the page indexes and Bloom filters of stored tables (default: up to 10 keys).
    # Parquet walks a list as a chain as deep as it is long, so a longer one, also one that a join hands over, is a range.
    "spark.sql.parquet.pushdown.inFilterThreshold": "64",
    # Clauses that were dealt by company stay so when they meet the filing dates, by company and filing.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # Lets a two-way partitioned write keep both files open instead of sorting the clause texts.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session and return it."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", memory: str = "8g", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the bench."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("clausemill")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local master, whose executors all live on this machine, may fall back to a temporary
    folder; on a cluster a missing setting is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="clausemill-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written intermediate table inside the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
