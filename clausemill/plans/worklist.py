"""Filing indexes and index pages to the next documents to fetch, and the manifest after fetching them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clausemill.operators.topk import first_k
from clausemill.operators.upsert import upsert_manifest
from clausemill.operators.worklist import next_documents, quarters_backward
from clausemill.sources.indexes import list_exhibits
from clausemill.sources.tables import write_table


def next_work(
    spark: SparkSession, filings: DataFrame, pages: DataFrame, manifest: DataFrame, year: int, quarter: int, n: int
) -> DataFrame:
    """The first ``n`` exhibits that are not completed, walking back from a quarter.

    ``filings`` is a parsed index with ``year, quarter, position`` (S4), ``pages`` has ``cik, accession, html``.
    Quarters come newest first, filings in index order, exhibits in the order of their page. A filing that the
    index names more than once (one line per registrant) gives its exhibits once, for its first line.
    """
    covered = quarters_backward(spark, year, quarter).select("year", "quarter")
    listed = list_exhibits(pages.select("cik", "accession", "html"), place="place")
    documents = filings.join(F.broadcast(covered), ["year", "quarter"]).join(listed, ["cik", "accession"])
    order = [F.desc("year"), F.desc("quarter"), F.col("position"), F.col("place")]
    once = first_k(documents, ["accession", "filename"], order, 1).drop("rank")
    return next_documents(once, manifest, n, ["position", "place"])


def record_finished(manifest: DataFrame, fetched: DataFrame, at: Column, out: str) -> None:
    """K1: write the next version of the manifest, with the ``fetched`` documents completed, to a new folder."""
    finished = fetched.select(
        "accession", "filename", "cik", "company", "form_type", F.col("exhibit_type").alias("file_type"), at.cast("timestamp").alias("downloaded_at")
    )
    write_table(upsert_manifest(manifest, finished), out)
