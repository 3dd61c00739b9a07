"""The corpus with its dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clausemill.functions.ids import clause_id

ENRICHED_COLUMNS = [
    "clause_id", "label", "section_header", "text", "cik", "company", "form_type", "file_type",
    "accession", "filename", "filing_date", "filing_year", "sic", "sic_description", "text_len",
]


def with_industry(clauses: DataFrame, companies: DataFrame) -> DataFrame:
    """Industry of the company; NULL when the company is unknown."""
    return clauses.join(companies.select("cik", "sic", "sic_description"), "cik", "left")


def with_filing_date(clauses: DataFrame, filing_dates: DataFrame) -> DataFrame:
    """Exact filing date; NULL when unknown or not a date."""
    dates = filing_dates.select("cik", "accession", F.try_to_date(F.col("filing_date").cast("string")).alias("filing_date"))
    return clauses.join(dates, ["cik", "accession"], "left")


def first_per_key(dimension: DataFrame, *keys: str) -> DataFrame:
    """K2: one row per key, so that a dimension with repeated keys does not multiply clauses."""
    rest = [c for c in dimension.columns if c not in keys]
    return dimension.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_last")).select(*keys, *[F.col(f"_last.{c}") for c in rest])


def needed(dimension: DataFrame, clauses: DataFrame, *keys: str) -> DataFrame:
    """The rows of a dimension that some clause asks for."""
    return dimension.join(clauses.select(*keys).distinct(), [*keys], "left_semi")


def with_id_and_length(clauses: DataFrame) -> DataFrame:
    """K3: add ``clause_id`` and ``text_len``."""
    return clauses.withColumns({"clause_id": clause_id(), "text_len": F.length("text")})


def enrich(clauses: DataFrame, companies: DataFrame, filing_dates: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The fifteen columns of the clause store, and any others of the corpus to ``keep``.

    Id and length are computed before the joins, so a reader that needs neither text nor header does
    not carry them through a shuffle.
    """
    keyed = clauses if "clause_id" in clauses.columns else with_id_and_length(clauses)
    joined = with_filing_date(with_industry(keyed, companies), filing_dates)
    return joined.select(*ENRICHED_COLUMNS, *keep)
