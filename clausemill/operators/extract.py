"""Documents to labelled clauses, without a shuffle.

A document's lines stay together in one array column, and headers, extents, bodies and the choice
between repeated headers are array expressions over it. The whole step is a narrow pipeline: scan,
one Arrow UDF for the HTML, projections, ``inline``. Exploding the lines and putting documents
together again with windows would send every line of the corpus through a shuffle, and again for
the join that brings the bodies back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clausemill.functions import headers as H
from clausemill.functions.ids import filing_year
from clausemill.functions.taxonomy import CONTRACTS, Taxonomy
from clausemill.functions.text import collapse_spaces, exhibit_body, header_key, html_lines, plain_lines
from clausemill.sources.exhibits import list_exhibits, read_listed

# Fixed value: shorter bodies are not clauses.
MIN_CLAUSE_CHARS = 30

# Ends of sections gathered at a time.
EXTENT_BLOCK = 128

CLAUSE_COLUMNS = ["label", "section_header", "text", "cik", "company", "form_type", "file_type", "accession", "filename", "filing_year"]


MAX_BYTES = 128 << 20  # of one exhibit; a worker needs some ten times as much


def with_lines(documents: DataFrame, raw: str = "raw", max_bytes: int = MAX_BYTES) -> DataFrame:
    """Replace the raw text by ``lines`` and ``error`` (NULL when the document was read).

    A document over ``max_bytes`` is not sent to a Python worker, whose memory it would exceed: it is one failed row,
    with its size, and the others are read.
    """
    size = F.octet_length(F.col(raw))
    small = F.when(size <= max_bytes, exhibit_body(F.col(raw)))
    too_large = F.when(size > max_bytes, F.concat(F.lit("TooLarge: "), size.cast("string"), F.lit(" bytes")))
    return (
        documents.withColumns({"_read": html_lines(small), "_too_large": too_large})
        .withColumns({"lines": F.col("_read.lines"), "error": F.coalesce("_too_large", "_read.error")})
        .drop("_read", "_too_large", raw)
    )


def with_plain_lines(documents: DataFrame, text: str = "text") -> DataFrame:
    """X2 for plain text documents."""
    return documents.withColumns({"lines": plain_lines(F.col(text)), "error": F.lit(None).cast("string")}).drop(text)


def _header_at(lines: Column, shapes: Column):
    """The header that begins on a line as ``(start_idx, title_idx, header_text, level)``, else NULL."""

    def header(shape: Column, i: Column) -> Column:
        before = F.get(shapes, i - 1)
        following = F.get(shapes, i + 1)
        split = H.starts_split_header(shape, following)
        title = i + split.cast("int")
        return F.when(
            H.starts_header(shape, before, following),
            F.struct(
                i.alias("start_idx"),
                title.alias("title_idx"),
                F.get(lines, title).alias("header_text"),
                H.header_level(F.get(lines, i), shape).alias("level"),
            ),
        )

    return header


def with_headers(documents: DataFrame) -> DataFrame:
    """Add ``headers``, the array of headers of each document in line order."""
    lines, shapes = F.col("lines"), F.col("_shapes")
    return (
        documents.withColumn("_shapes", F.transform(lines, H.line_shape))
        .withColumn("headers", F.array_compact(F.transform(shapes, _header_at(lines, shapes))))
        .drop("_shapes")
    )


def _extent_ends(headers: Column, line_count: Column) -> Column:
    """For each header the line where the next header of the same or a higher rank begins.

    One walk from the last header to the first. ``next_start[k-1]`` is the start of the nearest later
    header with level <= k; a header reads its own level's entry and then overwrites that entry and
    all deeper ones. Levels are not limited: the state is as long as the document's deepest level.
    An array that grows by one is copied each time, so ends are gathered in blocks of ``EXTENT_BLOCK``.
    """
    deepest = F.greatest(F.coalesce(F.array_max(F.transform(headers, lambda h: h["level"])), F.lit(1)), F.lit(1))
    nothing = F.array().cast("array<int>")
    state = F.struct(F.array_repeat(line_count, deepest).alias("next_start"), F.array().cast("array<array<int>>").alias("ends"))
    blocks = F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(headers) - 1, F.lit(0)), F.lit(EXTENT_BLOCK)),
        lambda at: F.slice(F.reverse(headers), at + 1, EXTENT_BLOCK),
    )

    def step(seen: Column, header: Column) -> Column:
        level = header["level"]
        return F.struct(
            F.transform(
                seen["next_start"],
                lambda start, i: F.when(i + 1 >= level, header["start_idx"]).otherwise(start),
            ).alias("next_start"),
            F.concat(seen["ends"], F.array(F.get(seen["next_start"], level - 1))).alias("ends"),
        )

    def block_step(seen: Column, block: Column) -> Column:
        return F.aggregate(
            block,
            F.struct(seen["next_start"].alias("next_start"), nothing.alias("ends")),
            step,
            lambda inner: F.struct(
                inner["next_start"].alias("next_start"), F.concat(seen["ends"], F.array(inner["ends"])).alias("ends")
            ),
        )

    return F.reverse(F.flatten(F.aggregate(blocks, state, block_step, lambda seen: seen["ends"])))


def with_sections(documents: DataFrame, taxonomy: Taxonomy = CONTRACTS) -> DataFrame:
    """Add ``sections``, the labelled headers with the lines their text spans."""
    headers = F.col("headers")
    labelled = F.zip_with(
        headers,
        F.col("_ends"),
        lambda h, end: F.struct(
            taxonomy.first_label(h["header_text"]).alias("label"),
            h["header_text"].alias("header_text"),
            h["level"].alias("level"),
            (h["title_idx"] + 1).alias("first_line"),
            end.alias("end_line"),
        ),
    )
    return (
        documents.withColumn("_ends", _extent_ends(headers, F.size("lines")))
        .withColumn("sections", F.filter(labelled, lambda s: s["label"].isNotNull()))
        .drop("_ends")
    )


def _body(lines: Column, section: Column) -> Column:
    """The text of a section. Lines are stripped and not empty, so its ends are clean."""
    start, end = section["first_line"], section["end_line"]
    return collapse_spaces(F.array_join(F.slice(lines, start + 1, F.greatest(end - start, F.lit(0))), "\n"))


def with_candidates(documents: DataFrame, min_chars: int = MIN_CLAUSE_CHARS) -> DataFrame:
    """Add ``candidates``, sections with a body of at least ``min_chars``."""
    lines = F.col("lines")
    bodies = F.transform(
        "sections",
        lambda s: F.struct(
            s["label"].alias("label"),
            collapse_spaces(s["header_text"]).alias("section_header"),
            _body(lines, s).alias("text"),
        ),
    )
    return documents.withColumn("candidates", F.filter(bodies, lambda c: F.length(c["text"]) >= min_chars))


def keep_longest(documents: DataFrame) -> DataFrame:
    """One clause per label and header spelling of a document, as rows with ``seq``.

    Of the same header in a contents list and in the body the longer text stays, the earlier one on a
    tie. ``seq`` is where the header first occurred. Small keys are sorted twice: with minus length and
    position, which puts the winner first in its run, and with the position alone, which puts the first
    occurrence there. Both orders have the same runs; the texts are fetched by position afterwards.
    """
    candidates, ranked, placed = F.col("candidates"), F.col("_ranked"), F.col("_placed")
    keyed = F.transform(
        candidates,
        lambda c, i: F.struct(
            F.concat(c["label"], F.lit("\n"), header_key(c["section_header"])).alias("key"),
            (-F.length(c["text"])).alias("neg_len"),
            i.alias("at"),
        ),
    )

    def heads(runs: Column) -> Column:
        return F.filter(runs, lambda r, i: (i == 0) | (F.get(runs, i - 1)["key"] != r["key"]))

    return (
        documents.withColumn("_keyed", keyed)
        .withColumn("_ranked", F.array_sort("_keyed"))
        .withColumn("_placed", F.array_sort(F.transform("_keyed", lambda k: F.struct(k["key"].alias("key"), k["at"].alias("at")))))
        .withColumn(
            "clauses",
            F.zip_with(
                heads(ranked),
                heads(placed),
                lambda r, first: F.struct(
                    (first["at"] + 1).alias("seq"),
                    F.get(candidates, r["at"])["label"].alias("label"),
                    F.get(candidates, r["at"])["section_header"].alias("section_header"),
                    F.get(candidates, r["at"])["text"].alias("text"),
                ),
            ),
        )
        .drop("_keyed", "_ranked", "_placed")
    )


def with_clauses(documents: DataFrame, taxonomy: Taxonomy = CONTRACTS) -> DataFrame:
    """X3-X15 for documents with ``lines``: one row per document with its ``clauses`` array."""
    found = keep_longest(with_candidates(with_sections(with_headers(documents), taxonomy)))
    return found.drop("lines", "headers", "sections", "candidates")


def array_rows(documents: DataFrame, array: str | Column, present: str, *kept: str) -> DataFrame:
    """The structs of an array column as rows, next to the ``kept`` columns.

    ``inline`` would make the optimizer infer "the array is not empty" and push that filter below the
    projections that compute the array, which then all run twice, lambdas nested in lambdas. The outer
    form infers nothing; rows of empty arrays are recognised by a field that is ``present`` otherwise.
    """
    return documents.select(*kept, F.inline_outer(array)).where(F.col(present).isNotNull())


def header_rows(documents: DataFrame) -> DataFrame:
    """One row per header of a document."""
    found = with_headers(documents)
    return array_rows(found, "headers", "start_idx", *[c for c in found.columns if c not in ("lines", "error", "headers")])


def line_rows(documents: DataFrame) -> DataFrame:
    """One row per line, numbered from 0."""
    kept = [c for c in documents.columns if c not in ("lines", "error")]
    return documents.select(*kept, F.posexplode_outer("lines").alias("i", "line")).where(F.col("i").isNotNull())


def extract(documents: DataFrame, taxonomy: Taxonomy = CONTRACTS) -> DataFrame:
    """Raw documents to rows, one per clause and one per document that could not be read.

    Clause rows have ``label``; rows of failed documents have ``error``. Documents without clauses
    give no row.
    """
    found = with_clauses(with_lines(documents), taxonomy)
    kept = [c for c in found.columns if c != "clauses"]
    return found.select(*kept, F.inline_outer("clauses")).where(
        F.col("label").isNotNull() | F.col("error").isNotNull()
    )


def completed(manifest: DataFrame) -> DataFrame:
    """Keys and attributes of the completed manifest rows."""
    return manifest.where(F.col("status") == "done").select("accession", "filename", "company", "form_type", "file_type")


def extract_completed(documents: DataFrame, manifest: DataFrame, taxonomy: Taxonomy = CONTRACTS) -> DataFrame:
    """Extract the documents whose manifest row is completed, with the manifest's attributes.

    ``documents`` has ``cik, accession, filename, raw``. The manifest is joined after extraction, where only
    clauses travel: before it, a manifest too large for a broadcast would shuffle the raw HTML. What this
    costs is the extraction of documents that are in the table but not completed; ``extract_listed`` does without.
    """
    return extract(documents, taxonomy).join(completed(manifest), ["accession", "filename"])


def extract_listed(spark: SparkSession, folder: str, manifest: DataFrame, taxonomy: Taxonomy = CONTRACTS) -> DataFrame:
    """``extract_completed`` for a folder of exhibit files, of which only the completed ones are opened.

    The manifest is joined to the files' names, so neither HTML nor clauses meet a join, and what is read falls with
    the share of completed documents.
    """
    wanted = list_exhibits(spark, folder).join(completed(manifest), ["accession", "filename"])
    found = extract(read_listed(wanted, folder, MAX_BYTES), taxonomy)
    size = F.col("length")
    too_large = F.when(size > MAX_BYTES, F.concat(F.lit("TooLarge: "), size.cast("string"), F.lit(" bytes")))
    return found.withColumn("error", F.coalesce(too_large, "error")).drop("length")


def clause_corpus(extracted: DataFrame) -> DataFrame:
    """The ten columns of the clause corpus."""
    return extracted.where(F.col("label").isNotNull()).withColumn("filing_year", filing_year(F.col("accession"))).select(*CLAUSE_COLUMNS)


def failed_documents(extracted: DataFrame) -> DataFrame:
    """Documents that could not be read, with the reason."""
    return extracted.where(F.col("error").isNotNull()).select("cik", "accession", "filename", "error")
