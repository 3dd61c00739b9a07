"""Raw exhibits to the clause corpus and its label gate."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from clausemill.functions.ids import filing_year
from clausemill.functions.taxonomy import CONTRACTS, Taxonomy
from clausemill.operators.extract import CLAUSE_COLUMNS, array_rows, extract_completed, extract_listed, with_clauses, with_lines
from clausemill.operators.profile import documents_scanned, frequency_gate, label_frequencies
from clausemill.session import scratch_path
from clausemill.sources.exhibits import read_exhibits_anywhere


@dataclass(frozen=True)
class CorpusResult:
    """Where the two outcomes were written, and how many rows each has."""

    clauses_path: str
    failed_path: str
    clauses: int
    failed: int


def build_corpus(
    spark: SparkSession, documents: DataFrame | str, manifest: DataFrame, out: str, taxonomy: Taxonomy = CONTRACTS
) -> CorpusResult:
    """Extract completed documents and write clauses and failures in one pass.

    ``documents`` is a folder of exhibit files, of which only the completed ones are opened, or a table
    ``cik, accession, filename, raw``. Both
    outcomes come from one write that is split by ``outcome``; the counts are observed while writing,
    so nothing is computed twice.
    """
    if isinstance(documents, str):
        extracted = extract_listed(spark, documents, manifest, taxonomy)
    else:
        extracted = extract_completed(documents, manifest, taxonomy)
    rows = (
        extracted.withColumn("filing_year", filing_year(F.col("accession")))
        .withColumn("outcome", F.when(F.col("error").isNull(), "clauses").otherwise("failed"))
        .select(*CLAUSE_COLUMNS, "error", "outcome")
    )
    seen = Observation()
    observed = rows.observe(
        seen,
        F.count_if(F.col("outcome") == "clauses").alias("clauses"),
        F.count_if(F.col("outcome") == "failed").alias("failed"),
    )
    observed.write.mode("overwrite").partitionBy("outcome").parquet(out)
    counts = seen.get
    return CorpusResult(f"{out}/outcome=clauses", f"{out}/outcome=failed", counts["clauses"], counts["failed"])


def label_report(spark: SparkSession, folder: str, taxonomy: Taxonomy = CONTRACTS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Label frequencies, gate verdict and documents scanned for a folder of exhibits.

    The exhibits are read once: what the reports need, the labels per document, is written to the shared
    folder, and all three tables come from there.
    """
    found = with_clauses(with_lines(read_exhibits_anywhere(spark, folder)), taxonomy)
    path = scratch_path(spark, "document-labels")
    found.select(F.transform("clauses", lambda c: F.struct(c["label"].alias("label"))).alias("clauses")).write.parquet(path)
    documents = spark.read.parquet(path)
    frequencies = label_frequencies(array_rows(documents, "clauses", "label"), taxonomy)
    return frequencies, frequency_gate(frequencies), documents_scanned(documents)
