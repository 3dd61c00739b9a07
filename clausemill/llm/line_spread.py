"""Line dedup by distinct-site spread (operator 7), with DataFrame functions only.

A line is boilerplate if it stands on at least ``min_sites`` sites. Sites per line are counted by HyperLogLog
sketches that merge by aggregation, so a line on a third of all rows sends one small sketch per task. Lines whose
estimate is too near the threshold to be sure of get an exact distinct count. Boilerplate lines are then removed
from the documents that hold them.

A document without a line of its own consists of such lines: it is a copy of something, not a carrier of
boilerplate. It stays whole, and which copy remains is left to near-dedup. Every other document loses its boilerplate
lines, whatever their share.

Lines are compared after trimming white space; lines without a word are never boilerplate. A null text has no
lines and stays null. A null site is no site. What is decided depends on text and site only, so repeated rows and
ids get equal results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clausemill.llm.common import GAP, let, row_key, stored, whole

MIN_SITES = 5
BLANKS = " \t\n\v\f\r"
SKETCH_BITS = 12  # a relative error of 1.04 / sqrt(2^12), or 1.6 percent
ERRORS = 6  # estimates within so many standard errors of the threshold are counted exactly


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS))


def _lines(text: str) -> Column:
    """The lines of a text with a word, as position, digest and characters."""
    every = F.transform(
        F.split(whole(text), "\n"),
        lambda line, at: F.struct(at.alias("at"), _trimmed(line).alias("line")),
    )
    return F.transform(
        F.filter(every, lambda x: x["line"] != ""),
        lambda x: F.struct(
            x["at"].alias("at"), F.unhex(F.md5(x["line"])).alias("digest"), F.length(x["line"]).alias("chars")
        ),
    )


def _digests(lines: Column) -> Column:
    return F.array_distinct(F.transform(lines, lambda x: x["digest"]))


def spread(docs: DataFrame, text: str = "text", site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """The lines that stand on at least so many sites: ``digest`` and ``n_sites``, an estimate or an exact count."""
    error = ERRORS * 1.04 / 2 ** (SKETCH_BITS / 2)
    low, high = min_sites / (1 + error) - 1, min_sites / (1 - error) + 1
    on_sites = docs.where(F.col(site).isNotNull()).select(
        F.col(site).cast("string").alias("site"), F.explode(_digests(_lines(text))).alias("digest")
    )
    sketched = (
        on_sites.groupBy("digest")
        .agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(SKETCH_BITS))).alias("n_sites"))
        .where(F.col("n_sites") >= low)
    )
    near = sketched.where(F.col("n_sites") <= high)
    exact = (
        on_sites.distinct()
        .join(near.select("digest"), "digest", "left_semi")
        .groupBy("digest")
        .agg(F.count("*").alias("n_sites"))
        .where(F.col("n_sites") >= min_sites)
    )
    return sketched.where(F.col("n_sites") > high).unionByName(exact)


def removed_lines(docs: DataFrame, boilerplate: DataFrame, text: str = "text", key: str = "key") -> DataFrame:
    """For documents that hold a boilerplate line: their ``key`` and the positions of such lines."""
    lines = docs.select(key, F.explode(_lines(text)).alias("line")).select(key, "line.*")
    return (
        lines.join(boilerplate.select("digest"), "digest", "left_semi")
        .groupBy(key)
        .agg(F.collect_set("at").alias("positions"))
    )


def dedup(
    docs: DataFrame,
    text: str = "text",
    site: str = "source",
    doc_id: str = "doc_id",
    min_sites: int = MIN_SITES,
) -> DataFrame:
    """Each row as ``row`` with ``clean``, its text without boilerplate lines, and how many lines and characters that took.

    ``kept_whole`` marks documents that keep such lines, being without another line.
    """
    keyed = docs.select(F.struct("*").alias("row"), row_key(doc_id, text).alias("key"))
    narrow = docs.select(F.col(text).alias("text"), row_key(doc_id, text).alias("key"))
    # Written first, so that the join below meets two shuffled sides, of which a very common line can be split.
    boilerplate = stored(docs.sparkSession, spread(docs, text, site, min_sites), "boilerplate-lines")
    removed = removed_lines(narrow, boilerplate)
    rows = keyed.join(removed, "key", "left").drop("key")
    body = F.col("row")[text]
    positions = F.coalesce("positions", F.array().cast("array<int>"))

    def without(lines: Column) -> Column:
        left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), positions)
        return F.array_join(F.transform(left, lambda at: F.get(lines, at)), "\n")

    def chars(body: Column) -> Column:
        return F.length(F.regexp_replace(body, GAP, "")).cast("long")

    touched = F.size(positions) > 0
    rows = rows.withColumn("rest", F.when(touched, let(F.split(whole(body), "\n"), without)))
    rows = rows.withColumns({"chars": F.when(touched, chars(whole(body))), "left": F.when(touched, chars(F.col("rest")))})
    return rows.select(
        "row",
        F.when(F.col("left") > 0, F.col("rest")).otherwise(body).alias("clean"),
        F.size(positions).cast("long").alias("n_boilerplate"),
        F.coalesce(F.col("chars") - F.col("left"), F.lit(0)).alias("boilerplate_chars"),
        (touched & (F.col("left") == 0)).alias("kept_whole"),
    )


def clean(docs: DataFrame, text: str = "text", site: str = "source", length: str | None = "n_chars") -> DataFrame:
    """All documents without boilerplate lines, in the columns they came with; ``length`` follows the text."""
    kinds = dict(docs.dtypes)
    out = []
    for name in docs.columns:
        if name == text:
            out.append(F.col("clean").alias(name))
        elif name == length:
            out.append(
                F.when(F.col("clean") == F.col("row")[text], F.col("row")[name])
                .otherwise(F.length("clean").cast(kinds[name]))
                .alias(name)
            )
        else:
            out.append(F.col("row")[name].alias(name))
    return dedup(docs, text, site).select(*out)
