"""What is still to do."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the earliest quarter is the first of this year.
FIRST_YEAR = 2001


def not_yet_done(documents: DataFrame, manifest: DataFrame) -> DataFrame:
    """Documents without a completed manifest row."""
    done = manifest.where(F.col("status") == "done").select("accession", "filename")
    return documents.join(done, ["accession", "filename"], "left_anti")


def unknown_companies(clauses: DataFrame, companies: DataFrame) -> DataFrame:
    """Companies of the corpus that the dimension lacks, once each."""
    return clauses.select("cik").distinct().join(companies.select("cik"), "cik", "left_anti")


def sorted_keys(rows: DataFrame, key: str) -> DataFrame:
    """C11: distinct keys in order, for display."""
    return rows.select(key).distinct().orderBy(key)


def quarters_backward(spark: SparkSession, year: int, quarter: int) -> DataFrame:
    """(position, year, quarter) from the given quarter back to the first one covered."""
    count = max(0, (year - FIRST_YEAR) * 4 + quarter)
    at = F.lit(year * 4 + quarter - 1) - F.col("id")
    return spark.range(count).select(
        F.col("id").cast("int").alias("position"),
        F.floor(at / 4).cast("int").alias("year"),
        (at % 4 + 1).cast("int").alias("quarter"),
    )


def next_documents(documents: DataFrame, manifest: DataFrame, n: int, within_quarter: list[str]) -> DataFrame:
    """The first ``n`` new documents, newest quarter first, then in index order."""
    order = [F.desc("year"), F.desc("quarter"), *within_quarter]
    return not_yet_done(documents, manifest).orderBy(*order).limit(n)
