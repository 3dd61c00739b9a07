"""Stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clausemill.sources import schemas
from clausemill.sources.store import read_store  # noqa: F401  (S11, with the other tables)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Completed manifest rows; the filter is pushed into the scan."""
    return spark.read.schema(schemas.MANIFEST).parquet(path).where(F.col("status") == "done")


def read_companies(spark: SparkSession, path: str) -> DataFrame:
    """S8."""
    return spark.read.schema(schemas.COMPANIES).parquet(path)


def read_filing_dates(spark: SparkSession, path: str) -> DataFrame:
    """S8."""
    return spark.read.schema(schemas.FILING_DATES).parquet(path)


def read_corpus(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """The clause corpus, or some of its columns."""
    corpus = spark.read.schema(schemas.CLAUSES).parquet(path)
    return corpus.select(*columns) if columns else corpus


def write_table(rows: DataFrame, path: str, *partition_by: str) -> None:
    """Write a table anew."""
    rows.write.mode("overwrite").option("compression", "zstd").partitionBy(*partition_by).parquet(path)


def write_json_lines(rows: DataFrame, path: str) -> None:
    """One JSON object per line; NULL fields stay as keys."""
    rows.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def read_json_lines(spark: SparkSession, path: str, schema: str = schemas.ENRICHED) -> DataFrame:
    """JSON lines with a declared schema, so a key written as a number is still read as a string."""
    return spark.read.schema(schema).json(path)


def write_assignments(assignments: DataFrame, path: str) -> None:
    """The recorded split."""
    assignments.select("cik", "bucket").write.mode("overwrite").parquet(path)


def read_assignments(spark: SparkSession, path: str) -> DataFrame:
    """S14."""
    return spark.read.schema(schemas.ASSIGNMENTS).parquet(path)
