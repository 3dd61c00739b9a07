"""Queries of sources and work lists: indexes, listings, submissions, manifest, corpus on disk."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clausemill.catalog import star
from clausemill.catalog.extraction import _CANDIDATES, _CORPUS, _FOUND, _HEADERS, _SECTIONS, _flags, _with, corpus
from clausemill.catalog.registry import query
from clausemill.operators import worklist as L
from clausemill.plans.corpus import build_corpus
from clausemill.plans.dimensions import backfill
from clausemill.plans.worklist import next_work, record_finished
from clausemill.session import scratch_path
from clausemill.sources import indexes, tables

# --- indexes -----------------------------------------------------------------------------------

_FORM = "CASE WHEN o_orderstatus = 'P' AND form_type = '10-K' THEN '10-K/A' ELSE coalesce(form_type, 'D') END"


def index_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Index lines of all filings. Pending annual reports are amendments; some company names are
    missing or hold a double blank, which breaks the five columns."""
    pending_annual = (F.col("o_orderstatus") == "P") & (F.col("form_type") == "10-K")
    form = F.when(pending_annual, "10-K/A").otherwise(F.coalesce("form_type", F.lit("D")))
    name = F.when(F.col("o_orderpriority") == "3-MEDIUM", F.replace("company", F.lit("#"), F.lit("  #"))).otherwise(F.col("company"))
    file_name = F.concat(F.lit("edgar/data/"), F.col("cik"), F.lit("/"), F.col("accession"), F.lit(".txt"))
    columns = [F.rpad(form, 12, " "), F.coalesce(name, F.lit("")), F.col("cik"), F.date_format("o_orderdate", "yyyy-MM-dd"), file_name]
    return star.filings(spark, folder).select("o_orderkey", F.concat_ws("    ", *columns, F.lit("")).alias("value"))


@query(
    "s4_filing_index",
    f"""SELECT o_orderkey, form_type, company, cik, strftime(o_orderdate, '%Y-%m-%d') AS date_filed, accession FROM filings
WHERE form_type IS NOT NULL AND {_FORM} <> '10-K/A' AND company IS NOT NULL AND o_orderpriority <> '3-MEDIUM'""",
)
def filing_index(spark, folder):
    return indexes.parse_index_lines(index_lines(spark, folder))


def index_pages(spark: SparkSession, folder: str) -> DataFrame:
    """The index page of each filing; pending filings have no document table."""

    def row(filename: str, kind: str, link: bool = True) -> str:
        cell = f'<a href="/x/{filename}"> {filename} </a>' if link else filename
        return f"<tr><td>1</td><td>d</td><td scope=row>{cell}</td><td>{kind}</td><td>9</td></tr>"

    documents = "".join(
        [
            "<tr><th>Seq</th><th>Type</th></tr>",
            row("main.htm", "10-K"),
            row("{f}", "{t}"),
            row("second&amp;{f}", "ex-10.22 "),
            row("schema.xsd", "EX-101.INS"),
            row("unlinked.htm", "EX-10.3", link=False),
            "<tr><td>2</td><td>short</td><td><a>short.htm</a></td></tr>",
        ]
    )
    start = '<html><body><table class="tableFile" summary="Data Files">' + row("data.htm", "EX-10.9") + "</table>"
    table = f'<table summary="Document Format Files" class="wide tableFile">{documents}</table>'
    filled = F.replace(F.replace(F.lit(table), F.lit("{f}"), F.col("filename")), F.lit("{t}"), F.col("file_type"))
    page = F.concat(F.lit(start), F.when(F.col("o_orderstatus") == "P", "").otherwise(filled), F.lit("</body></html>"))
    return star.filings(spark, folder).select("cik", "accession", page.alias("html"))


@query(
    "s5_exhibit_listing",
    """, listed AS (
  SELECT cik, accession, filename, file_type AS exhibit_type FROM filings WHERE o_orderstatus <> 'P'
  UNION ALL SELECT cik, accession, 'second&' || filename, 'ex-10.22' FROM filings WHERE o_orderstatus <> 'P')
SELECT *, 'https://www.sec.gov/Archives/edgar/data/' || cik || '/' || replace(accession, '-', '') || '/' || filename AS url FROM listed""",
)
def exhibit_listing(spark, folder):
    return indexes.list_exhibits(index_pages(spark, folder))


@query("s5_unreadable_pages", "SELECT cik, accession, 'TypeError' AS error_type FROM filings WHERE o_orderpriority = '5-LOW'")
def unreadable_pages(spark, folder):
    low = star.filings(spark, folder).where(F.col("o_orderpriority") == "5-LOW").select("accession", F.lit(True).alias("lost"))
    pages = index_pages(spark, folder).join(low, "accession", "left").withColumn("html", F.when(F.col("lost").isNull(), F.col("html")))
    found = indexes.unreadable_pages(pages.drop("lost"))
    return found.select("cik", "accession", F.substring_index("error", ":", 1).alias("error_type"))


def submissions(spark: SparkSession, folder: str) -> DataFrame:
    """One submissions document per filing; low-priority ones name two accessions but one date, pending
    ones have no recent filings, annual reports no industry."""
    date = F.date_format("o_orderdate", "yyyy-MM-dd")
    recent = F.struct(
        F.when(F.col("o_orderpriority") == "5-LOW", F.array("accession", F.lit("extra"))).otherwise(F.array("accession")).alias("accessionNumber"),
        F.array(date).alias("filingDate"),
    )
    body = F.to_json(
        F.struct(
            F.when(F.col("form_type").isNull() | (F.col("form_type") != "10-K"), F.col("file_type")).alias("sic"),
            F.col("company").alias("sicDescription"),
            F.when(F.col("o_orderstatus") != "P", F.struct(recent.alias("recent"))).alias("filings"),
        )
    )
    return star.filings(spark, folder).select("cik", body.alias("body"))


@query(
    "s6_submission_companies",
    "SELECT cik, CASE WHEN form_type IS DISTINCT FROM '10-K' THEN file_type END AS sic, company AS sic_description FROM filings",
)
def submission_companies(spark, folder):
    return indexes.companies_from(indexes.parse_submissions(submissions(spark, folder)))


def _broken_bodies(spark: SparkSession, folder: str) -> DataFrame:
    """Submissions of which those with an odd last digit are missing, cut off or no JSON."""
    digit = F.substring("cik", -1, 1)
    broken = F.when(digit == "1", None).when(digit == "3", "<html>503</html>").when(digit == "5", F.substring("body", 1, 8)).otherwise(F.col("body"))
    return submissions(spark, folder).withColumn("body", broken)


# A body without any value is "{}", of which the first eight characters are still a body.
_GOOD_BODY = """right(cik, 1) NOT IN ('1', '3', '5')
  OR (right(cik, 1) = '5' AND coalesce(form_type = '10-K', false) AND company IS NULL AND o_orderstatus = 'P')"""


@query(
    "s6_malformed_bodies",
    f"SELECT cik, NOT bool_or({_GOOD_BODY}) AS asked_again FROM filings GROUP BY cik",
)
def malformed_bodies(spark, folder):
    """The companies that J6 asks for again after a load of broken bodies."""
    bodies = _broken_bodies(spark, folder)
    known = indexes.companies_from(indexes.parse_submissions(bodies))
    every = star.filings(spark, folder).select("cik")
    again = L.unknown_companies(every, known).select("cik", F.lit(True).alias("again"))
    return every.distinct().join(again, "cik", "left").select("cik", F.coalesce("again", F.lit(False)).alias("asked_again"))


@query(
    "s6_submission_dates",
    "SELECT cik, accession, strftime(o_orderdate, '%Y-%m-%d') AS filing_date FROM filings WHERE o_orderstatus <> 'P'",
)
def submission_dates(spark, folder):
    return indexes.filing_dates_from(indexes.parse_submissions(submissions(spark, folder)))


# --- tables on disk ----------------------------------------------------------------------------


@query("s7_completed_manifest", "SELECT accession, filename, company, strftime(downloaded_at, '%Y-%m-%d') AS downloaded_on FROM manifest WHERE status = 'done'")
def completed_manifest(spark, folder):
    path = scratch_path(spark, "manifest")
    tables.write_table(star.manifest(spark, folder), path)
    done = tables.read_manifest(spark, path)
    return done.select("accession", "filename", "company", F.date_format("downloaded_at", "yyyy-MM-dd").alias("downloaded_on"))


@query("s8_company_dimension", "SELECT * FROM companies")
def company_dimension(spark, folder):
    path = scratch_path(spark, "companies")
    tables.write_table(star.companies(spark, folder), path)
    return tables.read_companies(spark, path)


@query("s8_date_dimension", "SELECT cik, accession, filing_date FROM filing_dates WHERE TRY_CAST(filing_date AS DATE) IS NOT NULL")
def date_dimension(spark, folder):
    path = scratch_path(spark, "filing-dates")
    dates = star.filing_dates(spark, folder).withColumn("filing_date", F.try_to_date("filing_date"))
    tables.write_table(dates.where(F.col("filing_date").isNotNull()), path)
    return tables.read_filing_dates(spark, path).withColumn("filing_date", F.col("filing_date").cast("string"))


_CORPUS_SQL = _with(_flags("lines"), _HEADERS, _SECTIONS, _CANDIDATES, _FOUND, _CORPUS, select="{select}")


@query("s9_label_column", _CORPUS_SQL.replace("{select}", "SELECT label, count(*) AS n FROM corpus GROUP BY label"))
def label_column(spark, folder):
    path = scratch_path(spark, "corpus")
    tables.write_table(corpus(spark, folder), path, "form_type")
    return tables.read_corpus(spark, path, "label").groupBy("label").agg(F.count("*").alias("n"))


@query("s10_written_corpus", _CORPUS_SQL.replace("{select}", "SELECT * REPLACE (md5(text) AS text) FROM corpus"))
def written_corpus(spark, folder):
    documents = star.exhibits(spark, folder).drop("doc_id")
    written = build_corpus(spark, documents, star.manifest(spark, folder), scratch_path(spark, "corpus-job"))
    return tables.read_corpus(spark, written.clauses_path).withColumn("text", F.md5("text"))


# --- work lists --------------------------------------------------------------------------------


def _listed(spark: SparkSession, folder: str) -> DataFrame:
    return star.filings(spark, folder).select(
        "accession", "filename", F.year("o_orderdate").alias("year"), F.quarter("o_orderdate").alias("quarter"), "o_orderkey"
    )


@query("j5_not_yet_done", "SELECT accession, filename FROM manifest WHERE status <> 'done'")
def not_yet_done(spark, folder):
    return L.not_yet_done(_listed(spark, folder), star.manifest(spark, folder)).select("accession", "filename")


@query("j6_unknown_companies", "SELECT DISTINCT cik FROM loaded WHERE cik NOT IN (SELECT cik FROM companies)")
def unknown_companies(spark, folder):
    return L.unknown_companies(star.clauses(spark, folder), star.companies(spark, folder))


@query("u2_missing_dates", "SELECT cik, accession FROM filings EXCEPT SELECT cik, accession FROM filing_dates")
def missing_dates(spark, folder):
    known = star.filing_dates(spark, folder).select("cik", "accession")
    return star.filings(spark, folder).select("cik", "accession").subtract(known)


@query("c11_sorted_companies", "SELECT DISTINCT cik FROM loaded ORDER BY cik")
def sorted_companies(spark, folder):
    return L.sorted_keys(star.clauses(spark, folder), "cik")


@query(
    "c6_next_documents",
    """SELECT accession, filename, CAST(extract(year FROM o_orderdate) AS INTEGER) AS year, CAST(extract(quarter FROM o_orderdate) AS INTEGER) AS quarter, o_orderkey
FROM filings WHERE o_orderstatus = 'P' ORDER BY year DESC, quarter DESC, o_orderkey LIMIT 500""",
)
def next_documents(spark, folder):
    return L.next_documents(_listed(spark, folder), star.manifest(spark, folder), 500, ["o_orderkey"])


@query(
    "c7_filings_per_quarter",
    """, latest AS (SELECT max(extract(year FROM o_orderdate) * 4 + extract(quarter FROM o_orderdate) - 1) AS q FROM orders),
quarters AS (SELECT CAST(q - s AS INTEGER) AS q, CAST(s AS INTEGER) AS position FROM latest, range(0, 400) t(s) WHERE q - s >= 8004)
SELECT position, q // 4 AS year, q % 4 + 1 AS quarter, count(o_orderkey) AS filings
FROM quarters LEFT JOIN orders ON extract(year FROM o_orderdate) * 4 + extract(quarter FROM o_orderdate) - 1 = q GROUP BY ALL""",
)
def filings_per_quarter(spark, folder):
    listed = _listed(spark, folder)
    newest = listed.agg(F.max(F.struct("year", "quarter")).alias("q")).select("q.*").first()
    counts = listed.groupBy("year", "quarter").agg(F.count("*").alias("filings"))
    back = L.quarters_backward(spark, newest["year"], newest["quarter"])
    return back.join(counts, ["year", "quarter"], "left").na.fill(0, ["filings"])


# --- jobs --------------------------------------------------------------------------------------


@query(
    "j6_backfill_job",
    f""", unknown AS (SELECT DISTINCT cik FROM clauses WHERE cik NOT IN (SELECT cik FROM companies)),
bodies AS (SELECT cik, CASE WHEN form_type IS DISTINCT FROM '10-K' THEN file_type END AS sic, company AS sic_description FROM filings
  WHERE cik IN (SELECT cik FROM unknown) AND ({_GOOD_BODY})),
new_dates AS (SELECT cik, accession, CAST(o_orderdate AS DATE) AS filing_date FROM filings
  WHERE o_orderstatus <> 'P' AND cik IN (SELECT cik FROM unknown) AND ({_GOOD_BODY}))
SELECT 'company' AS kind, cik, sic AS key, sic_description AS value FROM companies
UNION ALL SELECT 'company', * FROM bodies QUALIFY row_number() OVER (PARTITION BY cik ORDER BY sic DESC NULLS LAST, sic_description DESC NULLS LAST) = 1
UNION ALL SELECT 'date', cik, accession, CAST(TRY_CAST(filing_date AS DATE) AS VARCHAR) FROM filing_dates
  WHERE (cik, accession) NOT IN (SELECT cik, accession FROM new_dates)
UNION ALL SELECT 'date', cik, accession, CAST(filing_date AS VARCHAR) FROM new_dates
UNION ALL SELECT DISTINCT 'malformed', cik, NULL, NULL FROM filings WHERE cik IN (SELECT cik FROM unknown) AND NOT ({_GOOD_BODY})""",
)
def backfill_job(spark, folder):
    """Both dimensions after a backfill from bodies of which some are broken."""
    corpus = star.filings(spark, folder).join(
        star.table(spark, folder, "lineitem").select("l_orderkey"), F.col("o_orderkey") == F.col("l_orderkey"), "left_semi"
    )
    bodies = _broken_bodies(spark, folder)
    out = scratch_path(spark, "backfill")
    done = backfill(spark, corpus.select("cik"), bodies, star.companies(spark, folder), star.filing_dates(spark, folder), out)
    companies = tables.read_companies(spark, done.companies_path)
    dates = tables.read_filing_dates(spark, done.filing_dates_path)
    malformed = spark.read.schema("cik string, body string").parquet(done.malformed_path).select("cik").distinct()
    nothing = F.lit(None).cast("string")
    return (
        companies.select(F.lit("company").alias("kind"), "cik", F.col("sic").alias("key"), F.col("sic_description").alias("value"))
        .unionByName(dates.select(F.lit("date").alias("kind"), "cik", F.col("accession").alias("key"), F.col("filing_date").cast("string").alias("value")))
        .unionByName(malformed.select(F.lit("malformed").alias("kind"), "cik", nothing.alias("key"), nothing.alias("value")))
    )


@query(
    "c6_work_list_job",
    """, listed AS (
  SELECT accession, 'second&' || filename AS filename, cik, company, form_type, 'ex-10.22' AS file_type, 'done' AS status, o_orderdate, o_orderkey FROM filings
  WHERE o_orderstatus <> 'P' AND form_type IS NOT NULL AND company IS NOT NULL AND o_orderpriority <> '3-MEDIUM' AND extract(year FROM o_orderdate) >= 2001),
fetched AS (
  SELECT accession, filename, cik, company, form_type, file_type, status FROM listed
  ORDER BY extract(year FROM o_orderdate) DESC, extract(quarter FROM o_orderdate) DESC, o_orderkey LIMIT 500)
SELECT accession, filename, cik, company, form_type, file_type, status FROM manifest UNION ALL SELECT * FROM fetched""",
)
def work_list_job(spark, folder):
    """The manifest after the next 500 documents were fetched; the first exhibit of each page is completed already.

    Quarters before the first one covered (2001) are never walked.
    """
    days = star.filings(spark, folder).select("o_orderkey", F.year("o_orderdate").alias("year"), F.quarter("o_orderdate").alias("quarter"))
    lines = index_lines(spark, folder).join(days, "o_orderkey").withColumnRenamed("o_orderkey", "position")
    newest = days.agg(F.max(F.struct("year", "quarter")).alias("q")).select("q.*").first()
    filings, manifest = indexes.parse_index_lines(lines), star.manifest(spark, folder)
    fetched = next_work(spark, filings, index_pages(spark, folder), manifest, newest["year"], newest["quarter"], 500)
    out = scratch_path(spark, "manifest")
    record_finished(manifest, fetched, F.lit("2024-01-01"), out)
    return spark.read.parquet(out).drop("downloaded_at")
