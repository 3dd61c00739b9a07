"""K1, K2, K4: keyed writes as pure functions from (old rows, new rows) to the next version."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from clausemill.operators.topk import latest_per_key

REQUIRED_COLUMNS = ["clause_id", "label", "section_header", "text", "cik", "accession", "filename"]


def upsert_manifest(manifest: DataFrame, finished: DataFrame) -> DataFrame:
    """K1: one row per (accession, filename) after marking ``finished`` documents as done.

    A new key keeps the attributes it first came with; a known key only gets its status and time
    refreshed. Both inputs carry ``downloaded_at``; among rows of one time the order of the attributes
    decides, so the result does not depend on partitioning. Hash aggregation cannot hold strings, so rows
    are sorted, once and in shares of the shuffle, not of the scans and joins below it; the copies of a key meet in one task.
    """
    attributes = F.struct("cik", "company", "form_type", "file_type")
    rows = manifest.withColumn("_new", F.lit(0)).unionByName(
        finished.withColumns({"_new": F.lit(1), "status": F.lit("done")}).select(*manifest.columns, "_new")
    )
    first = F.min(F.struct("_new", "downloaded_at", attributes.alias("attributes")))["attributes"]
    merged = rows.repartition("accession", "filename").groupBy("accession", "filename").agg(
        first.alias("first"),
        F.max(F.struct("_new", "downloaded_at", "status")).alias("last"),
    )
    return merged.select(
        "accession", "filename", "first.cik", "first.company", "first.form_type", "first.file_type", "last.status", "last.downloaded_at"
    )


def upsert_rows(current: DataFrame, incoming: DataFrame, keys: list[str], newest_first: list[Column]) -> DataFrame:
    """K2: last write wins on the whole row; every incoming row beats every current row."""
    rows = current.withColumn("_incoming", F.lit(0)).unionByName(incoming.withColumn("_incoming", F.lit(1)))
    return latest_per_key(rows, keys, [F.desc("_incoming"), *newest_first]).drop("_incoming")


def is_loadable() -> Column:
    """K4: rows that satisfy the store's schema."""
    present = F.lit(True)
    for name in REQUIRED_COLUMNS:
        present = present & F.col(name).isNotNull()
    return present


def rejected(enriched: DataFrame) -> DataFrame:
    """K4: rows the store does not accept."""
    return enriched.where(~is_loadable())


def load(clauses: DataFrame, newest_first: list[Column], offered: Observation | None = None, within: tuple[str, ...] = ()) -> DataFrame:
    """K4: one row per ``clause_id``, the newest; loading the same rows again changes nothing.

    The clauses are computed once and shuffled once, by their id, and older rows of a task are cut below the shuffle.
    To find the repeated ids first would compute the clauses three times over and, once these ids are too many for a
    broadcast, shuffle them whole twice. ``offered`` observes rows and refused rows in the read that brings the rows.
    ``within`` names columns in which rows of one id always agree: rows that are dealt by these are not shuffled again.
    """
    observed = clauses
    if offered is not None:
        observed = clauses.observe(offered, F.count("*").alias("rows"), F.count_if(~is_loadable()).alias("refused"))
    return latest_per_key(observed.where(is_loadable()), [*within, "clause_id"], newest_first)
