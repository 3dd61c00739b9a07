"""Identifiers, hashes and scores as native expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from clausemill.functions.taxonomy import CONTRACTS, Taxonomy
from clausemill.functions.text import strip_space

# The split is the hash of this seed and the company key, cut at 70 % and 85 %.
SPLIT_SEED = "lora-clause-split-v1"
SPLIT_CUTS = [("train", 7000), ("val", 8500), ("test", 10000)]
# Seed of the sampling order, and the score's short-text and bare-header rules.
SAMPLE_SEED = 42
SHORT_TEXT = 60
BARE_HEADERS = ["confidential", "termination", "payment"]


def source_id(accession: Column, filename: Column) -> Column:
    """X19."""
    return F.concat_ws("/", accession, filename)


def filing_year(accession: Column) -> Column:
    """``20`` and the two digits between the dashes of an accession number, else NULL."""
    parts = F.split(accession, "-")
    return F.when(accession.rlike(r"^[^-]*-(?U:\d{2})-[^-]*$"), F.concat(F.lit("20"), F.get(parts, F.lit(1))))


def clause_id() -> Column:
    """K3: hex SHA-1 over accession, file name, label and section header."""
    return F.sha1(F.concat_ws(":", "accession", "filename", "label", "section_header"))


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once per row.

    In a filter Spark computes a repeated subexpression anew each time; the variable of a lambda is bound
    once.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def split_point(cik: Column | str, seed: str = SPLIT_SEED) -> Column:
    """SHA-256 of ``seed:cik`` as a 256-bit number, modulo 10,000.

    The digest is read in pieces that fit a BIGINT and folded with Horner's rule.
    """

    def fold(digest: Column) -> Column:
        folded = F.conv(F.substring(digest, 1, 4), 16, 10).cast("bigint")
        for start in range(5, 65, 12):
            piece = F.conv(F.substring(digest, start, 12), 16, 10).cast("bigint")
            folded = (folded * F.lit(pow(16, 12, 10000)) + piece) % F.lit(10000)
        return folded.cast("int")

    return _once(F.sha2(F.concat(F.lit(f"{seed}:"), cik), 256), fold)


def split_bucket(cik: Column, seed: str = SPLIT_SEED) -> Column:
    """The bucket of a company. A pure function of the key, so it needs no lookup join."""
    (first, first_cut), (second, second_cut), (last, _) = SPLIT_CUTS
    return _once(
        split_point(cik, seed),
        lambda point: F.when(point < first_cut, F.lit(first)).when(point < second_cut, F.lit(second)).otherwise(F.lit(last)),
    )


def shuffle_key(identifier: Column, seed: int = SAMPLE_SEED) -> Column:
    """Position of a row in the seeded order; the same under every partitioning."""
    return F.sha2(F.concat(F.lit(f"{seed}:"), identifier), 256)


def ambiguity_score(header: Column, text_len: Column, taxonomy: Taxonomy = CONTRACTS) -> Column:
    """P10: extra categories in the header, plus one for a short text, plus one for a bare header."""
    bare = F.lower(F.rtrim(strip_space(header), F.lit(".:")))
    return (
        taxonomy.label_count(header)
        - 1
        + (text_len < SHORT_TEXT).cast("int")
        + bare.isin(BARE_HEADERS).cast("int")
    )
