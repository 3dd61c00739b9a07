"""Filing indexes, exhibit listings and company submissions that are already in storage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clausemill.functions.text import document_table, strip_space
from clausemill.sources.schemas import SUBMISSIONS

# Root forms that carry contracts (no amendments), the exhibit type wanted, and where
# documents are published.
ROOT_FORMS = ["10-K", "10-Q", "8-K", "S-1"]
EXHIBIT_TYPE = r"(?i)^EX-10(?!\d)"
ARCHIVE = "https://www.sec.gov/Archives/edgar/data"


def parse_index_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """Index lines to filings. A line counts when it has exactly five parts and a wanted form type.

    The heading and the rule of dashes fail those two tests, so lines need no order. Other columns of
    ``lines`` (quarter, position) are kept.
    """
    kept = [c for c in lines.columns if c != value]
    parts = F.split(strip_space(F.col(value)), r"(?U)[\s\x1c-\x1f]{2,}")
    name = F.element_at(F.split(F.get("_parts", F.lit(4)), "/"), -1)
    return (
        lines.withColumn("_parts", parts)
        .where((F.size("_parts") == 5) & F.get("_parts", F.lit(0)).isin(ROOT_FORMS))
        .select(
            *kept,
            F.get("_parts", F.lit(0)).alias("form_type"),
            F.get("_parts", F.lit(1)).alias("company"),
            F.get("_parts", F.lit(2)).alias("cik"),
            F.get("_parts", F.lit(3)).alias("date_filed"),
            F.regexp_replace(name, r"\.txt$", "").alias("accession"),
        )
    )


def read_filing_index(spark: SparkSession, folder: str) -> DataFrame:
    """All ``{year}/QTR{quarter}/form.idx`` files below a folder.

    ``position`` follows the order of the lines within a quarter: files are read in splits, so it is
    made of the split's offset and the line's place in the split.
    """
    text = spark.read.text(f"{folder.rstrip('/')}/*/QTR*/form.idx").select(
        "value",
        F.regexp_extract("_metadata.file_path", r"/(\d{4})/QTR(\d)/", 1).cast("int").alias("year"),
        F.regexp_extract("_metadata.file_path", r"/(\d{4})/QTR(\d)/", 2).cast("int").alias("quarter"),
        F.struct(
            F.col("_metadata.file_block_start").alias("offset"), F.monotonically_increasing_id().alias("line")
        ).alias("position"),
    )
    return parse_index_lines(text)


def _document_url(cik: Column, accession: Column, filename: Column) -> Column:
    return F.concat_ws("/", F.lit(ARCHIVE), cik, F.replace(accession, F.lit("-"), F.lit("")), filename)


def read_index_pages(pages: DataFrame, page: str = "html") -> DataFrame:
    """Stored index pages (``cik, accession`` and the page) with ``rows`` of their table, or an ``error``.

    The table is read by an Arrow UDF.
    """
    kept = [c for c in pages.columns if c != page]
    return pages.select(*kept, document_table(F.col(page)).alias("_table")).select(*kept, "_table.rows", "_table.error")


def list_exhibits(pages: DataFrame, page: str = "html", place: str | None = None) -> DataFrame:
    """Stored index pages to the exhibits they list, with the row of the table as ``place`` if it is named."""
    read = read_index_pages(pages, page)
    kept = [c for c in read.columns if c not in ("rows", "error")]
    rows = F.col("rows") if place is None else F.transform("rows", lambda row, i: row.withField(place, i))
    listed = read.select(*kept, F.inline_outer(rows))
    return listed.where(F.col("exhibit_type").rlike(EXHIBIT_TYPE)).withColumn(
        "url", _document_url(F.col("cik"), F.col("accession"), F.col("filename"))
    )


def unreadable_pages(pages: DataFrame, page: str = "html") -> DataFrame:
    """Pages that could not be read, with the reason, so that they are not taken for pages without exhibits."""
    return read_index_pages(pages, page).where(F.col("error").isNotNull()).drop("rows")


def _parsed(bodies: DataFrame, body: str) -> DataFrame:
    options = {"columnNameOfCorruptRecord": "_malformed"}
    parsed = F.from_json(F.col(body), f"{SUBMISSIONS}, _malformed string", options)
    return bodies.withColumn("_s", parsed).withColumn("_good", F.col("_s").isNotNull() & F.col("_s._malformed").isNull())


def parse_submissions(bodies: DataFrame, body: str = "body") -> DataFrame:
    """One JSON document per company to ``cik, sic, sic_description, recent``; malformed bodies give no row.

    ``{}`` is a good body without values: its company becomes known, with NULLs.
    """
    return _parsed(bodies, body).where("_good").select(
        "cik",
        F.col("_s.sic").alias("sic"),
        F.col("_s.sicDescription").alias("sic_description"),
        F.col("_s.filings.recent").alias("recent"),
    )


def malformed_submissions(bodies: DataFrame, body: str = "body") -> DataFrame:
    """Companies whose body could not be parsed or is missing; they stay unknown and are asked for again."""
    return _parsed(bodies, body).where("NOT _good").select("cik", body)


def companies_from(submissions: DataFrame) -> DataFrame:
    """The company dimension rows."""
    return submissions.select("cik", "sic", "sic_description")


def filing_dates_from(submissions: DataFrame) -> DataFrame:
    """The parallel arrays as rows; the longer array's surplus is dropped."""
    accessions, dates = F.col("recent.accessionNumber"), F.col("recent.filingDate")
    shortest = F.least(F.coalesce(F.size(accessions), F.lit(0)), F.coalesce(F.size(dates), F.lit(0)))
    pairs = F.arrays_zip(
        F.slice(accessions, F.lit(1), shortest).alias("accession"), F.slice(dates, F.lit(1), shortest).alias("filing_date")
    )
    rows = submissions.where(shortest > 0).select("cik", F.inline_outer(pairs).alias("accession", "filing_date"))
    return rows.where(F.col("accession").isNotNull() & F.col("filing_date").isNotNull())
