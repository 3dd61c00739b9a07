"""Stored submissions to the company and filing-date dimensions of a corpus."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clausemill.operators.upsert import upsert_rows
from clausemill.operators.worklist import unknown_companies
from clausemill.session import scratch_path
from clausemill.sources.indexes import companies_from, filing_dates_from, malformed_submissions, parse_submissions
from clausemill.sources.tables import write_table


@dataclass(frozen=True)
class BackfillResult:
    """Where the next version of both dimensions is, and the bodies that could not be read."""

    companies_path: str
    filing_dates_path: str
    malformed_path: str


def backfill(
    spark: SparkSession, clauses: DataFrame, bodies: DataFrame, companies: DataFrame, filing_dates: DataFrame, out: str
) -> BackfillResult:
    """Add the corpus's unknown companies and their filing dates to the dimensions.

    ``bodies`` has ``cik, body``; only bodies of companies that the corpus has and the dimension lacks are read.
    A malformed or missing body is written apart and its company stays unknown, so the next run asks again. Of
    several bodies of one company the greater row stays. ``out`` is a new folder: the versions given stay as
    they are, and a run that fails leaves no half-loaded dimension behind.
    """
    wanted = unknown_companies(clauses, companies)
    asked, asked_path = bodies.select("cik", "body").join(wanted, "cik", "left_semi"), scratch_path(spark, "asked")
    asked.write.parquet(asked_path)
    asked = spark.read.schema(asked.schema).parquet(asked_path)
    result = BackfillResult(f"{out}/companies", f"{out}/filing_dates", f"{out}/malformed")
    found = parse_submissions(asked)
    newest = [F.desc("sic"), F.desc("sic_description")]
    write_table(upsert_rows(companies.select("cik", "sic", "sic_description"), companies_from(found), ["cik"], newest), result.companies_path)

    def dated(rows: DataFrame) -> DataFrame:
        return rows.select("cik", "accession", F.try_to_date(F.col("filing_date").cast("string")).alias("filing_date"))

    dates = upsert_rows(dated(filing_dates), dated(filing_dates_from(found)), ["cik", "accession"], [F.desc("filing_date")])
    write_table(dates, result.filing_dates_path)
    write_table(malformed_submissions(asked), result.malformed_path)
    return result
