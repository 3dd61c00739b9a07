"""The corpus profile as tables.

Statistics of text lengths all come from one small table, the number of clauses per label and
length. It has at most (labels x longest text) rows however large the corpus is, so exact medians and
quartiles need neither a sort of the corpus nor a group collected in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clausemill.functions.taxonomy import CONTRACTS, Taxonomy
from clausemill.session import scratch_path

# Fixed values of the profile.
UNCLASSIFIED = ["", "0000"]
LONG_TEXT = 10_000
HISTOGRAM_LIMIT = 5_000
HISTOGRAM_BINS = 60


def _count(weight: str | None, where: Column | None = None) -> Column:
    """The number of rows (that satisfy a condition), or of those that the lines of a table of counts stand for."""
    if weight is None:
        return F.count("*") if where is None else F.count_if(where)
    return F.coalesce(F.sum(weight if where is None else F.when(where, F.col(weight))), F.lit(0))


def count_by(rows: DataFrame, key: str, weight: str | None = None) -> DataFrame:
    """Rows per value; the NULL group is left out.

    Here and below, ``rows`` may be a table of counts as well, whose column ``weight`` says how many rows a line stands for.
    """
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(_count(weight).alias("n"))


def label_shares(rows: DataFrame, weight: str | None = None) -> DataFrame:
    """A2, A3: count and percentage per label."""
    counts = count_by(rows, "label", weight)
    total = F.sum("n").over(Window.partitionBy())
    return counts.withColumn("pct", F.try_divide(F.lit(100.0) * F.col("n"), total))


def label_frequencies(rows: DataFrame, taxonomy: Taxonomy = CONTRACTS, weight: str | None = None) -> DataFrame:
    """A4: every label of the taxonomy with count and percentage, also at zero."""
    counts = count_by(rows, "label", weight)
    listed = (
        taxonomy.table(rows.sparkSession)
        .select("ord", "label")
        .join(counts, "label", "left")
        .select("ord", "label", F.coalesce("n", F.lit(0)).alias("n"))
    )
    total = F.sum("n").over(Window.partitionBy())
    return listed.withColumn("pct", F.when(total > 0, F.lit(100.0) * F.col("n") / total).otherwise(0.0))


def frequency_gate(frequencies: DataFrame) -> DataFrame:
    """A5: PASS, or FAIL and the labels that never occur, in one row."""
    missing = F.array_sort(F.collect_list(F.when(F.col("n") == 0, F.struct("ord", "label"))))
    return frequencies.agg(missing.alias("m")).select(
        F.when(F.size("m") == 0, "PASS").otherwise("FAIL").alias("verdict"),
        F.array_join(F.transform("m", lambda x: x["label"]), ", ").alias("missing"),
    )


def top_terms(rows: DataFrame, key: str, n: int = 20) -> DataFrame:
    """The most frequent values, ties by value."""
    return count_by(rows, key).orderBy(F.desc("n"), key).limit(n)


def distinct_counts(rows: DataFrame, columns: list[str], weight: str | None = None) -> DataFrame:
    """Rows and distinct values per column, in one row.

    Each column is grouped by itself, from a scan of that column alone; several distinct counts in one
    aggregate would send every row through the shuffle once per column.
    """
    parts = []
    for c in columns:
        values = rows.groupBy(F.col(c).alias("value")).agg(_count(weight).alias("n"))
        parts.append(values.agg(F.sum("n").alias("rows"), F.count("value").alias("n")).withColumn("of", F.lit(c)))
    every = reduce(DataFrame.unionByName, parts)
    found = [F.max(F.when(F.col("of") == c, F.col("n"))).alias(f"distinct_{c}") for c in columns]
    return every.agg(F.coalesce(F.max("rows"), F.lit(0)).alias("rows"), *found)


def nulls_per_column(columns: list[str]) -> list[Column]:
    """The aggregates that count NULLs, one per column and under its name."""
    return [F.count_if(F.col(c).isNull()).alias(c) for c in columns]


def _as_rows(counted: DataFrame) -> DataFrame:
    pairs = ", ".join(f"'{c}', `{c}`" for c in counted.columns)
    return counted.selectExpr(f"stack({len(counted.columns)}, {pairs}) AS (column_name, nulls)")


def null_counts(rows: DataFrame) -> DataFrame:
    """NULLs per column, one pass, as rows."""
    return _as_rows(rows.agg(*nulls_per_column(rows.columns)))


def added_null_counts(parts: DataFrame) -> DataFrame:
    """A9 from the counts of parts, one line per part."""
    return _as_rows(parts.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in parts.columns]))


def row_digest(*columns: str) -> Column:
    """SHA-256 of the JSON form of some columns, which tells a missing value from an empty one."""
    return F.unhex(F.sha2(F.to_json(F.struct(*columns)), 256))


def _surplus(rows: DataFrame, keys: list[Column | str]) -> DataFrame:
    counts = rows.groupBy(*keys).agg(F.count("*").alias("n"))
    return counts.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))


def duplicate_rows(rows: DataFrame) -> DataFrame:
    """A10: rows beyond the first of each set of equal rows.

    Rows are compared by the SHA-256 of their JSON form (which tells a missing value from an empty
    one), so that 32 bytes per row are shuffled and not the texts.
    """
    return _surplus(rows.select(row_digest(*rows.columns).alias("digest")), ["digest"])


def duplicate_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows beyond the first of each key."""
    return _surplus(rows, keys)


def imbalance(rows: DataFrame, weight: str | None = None) -> DataFrame:
    """Largest label over smallest."""
    return count_by(rows, "label", weight).agg(F.try_divide(F.max("n"), F.min("n")).alias("ratio"))


def length_counts(rows: DataFrame) -> DataFrame:
    """Clauses per label and text length, the base of A13-A18."""
    return rows.groupBy("label", "text_len").agg(F.count("*").alias("n"))


def _percentile(at: float) -> Column:
    return F.percentile("text_len", F.lit(at), F.col("n"))


def length_summary(lengths: DataFrame) -> DataFrame:
    """Count, mean, sample deviation, extremes and quartiles of the text length.

    Sums are exact integers, so the deviation does not depend on the order of the rows.
    """
    by_length = lengths.groupBy("text_len").agg(F.sum("n").alias("n"))
    sums = by_length.agg(
        F.sum("n").alias("count"),
        F.sum((F.col("n") * F.col("text_len")).cast("decimal(28,0)")).alias("total"),
        F.sum((F.col("n") * F.col("text_len")).cast("decimal(28,0)") * F.col("text_len")).alias("squares"),
        F.min("text_len").alias("min"),
        _percentile(0.25).alias("q1"),
        _percentile(0.5).alias("median"),
        _percentile(0.75).alias("q3"),
        F.max("text_len").alias("max"),
    )
    count, total, squares = F.col("count").cast("double"), F.col("total").cast("double"), F.col("squares").cast("double")
    return sums.select(
        "count",
        F.try_divide(total, count).alias("mean"),
        F.when(F.col("count") > 1, F.sqrt(F.greatest(squares - total * total / count, F.lit(0.0)) / (count - 1))).alias("std"),
        "min", "q1", "median", "q3", "max",
    )


def label_medians(lengths: DataFrame) -> DataFrame:
    """Median length per label (shortest first when displayed)."""
    return lengths.groupBy("label").agg(_percentile(0.5).alias("median_len"))


def length_histogram(lengths: DataFrame, limit: int = HISTOGRAM_LIMIT, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Equal bins over the clipped length, the last one closed. Empty bins have no row."""
    clipped = lengths.groupBy(F.least("text_len", F.lit(limit)).alias("v")).agg(F.sum("n").alias("n"))
    everything = Window.partitionBy()
    spread = clipped.withColumns({"lo": F.min("v").over(everything), "hi": F.max("v").over(everything)})
    place = F.when(F.col("hi") == F.col("lo"), 1).otherwise(
        F.least(F.width_bucket("v", F.col("lo"), F.col("hi"), F.lit(bins)), F.lit(bins))
    )
    return spread.groupBy(place.cast("int").alias("bin")).agg(F.sum("n").alias("n"))


def length_boxes(lengths: DataFrame) -> DataFrame:
    """Quartiles per label and the furthest lengths within 1.5 interquartile ranges."""
    quartiles = lengths.groupBy("label").agg(
        _percentile(0.25).alias("q1"), _percentile(0.5).alias("median"), _percentile(0.75).alias("q3")
    )
    reach = (F.col("q3") - F.col("q1")) * 1.5
    inside = F.col("text_len").between(F.col("q1") - reach, F.col("q3") + reach)
    return (
        lengths.join(quartiles, "label")
        .where(inside)
        .groupBy("label", "q1", "median", "q3")
        .agg(F.min("text_len").alias("whisker_low"), F.max("text_len").alias("whisker_high"))
    )


def over_length(lengths: DataFrame, threshold: int = LONG_TEXT) -> DataFrame:
    """Clauses longer than a threshold, and their percentage."""
    over = F.sum(F.when(F.col("text_len") > threshold, F.col("n")).otherwise(0))
    return lengths.agg(over.alias("over"), F.try_divide(F.lit(100.0) * over, F.sum("n")).alias("pct"))


def company_sizes(rows: DataFrame, weight: str | None = None) -> DataFrame:
    """Clauses per company name."""
    return count_by(rows, "company", weight)


def median_company_size(sizes: DataFrame) -> DataFrame:
    """Median clauses per company, from A19 by way of the table of distinct sizes."""
    counts = sizes.groupBy("n").agg(F.count("*").alias("companies"))
    return counts.agg(F.percentile("n", F.lit(0.5), F.col("companies")).alias("median_size"))


def ranged_sizes(sizes: DataFrame) -> DataFrame:
    """Companies (A19) in ranges by size, a hash part and name, written to the shared folder with the number of their ``range``.

    The ranges are cut by a sample of all three, so many companies of one size are spread over as many ranges as they
    need. Written, a company's range stays what it is whatever is computed again.
    """
    spark = sizes.sparkSession
    parted = sizes.withColumn("part", F.substring(F.md5("company"), 1, 2))
    placed = parted.repartitionByRange(*_curve_order()).withColumn("range", F.spark_partition_id())
    path = scratch_path(spark, "ranged-sizes")
    placed.write.parquet(path)
    return spark.read.schema(placed.schema).parquet(path)


def concentration(sizes: DataFrame) -> DataFrame:
    """Companies (A19) by size with ``rank``, running count and running percentage of all clauses.

    Equal sizes are ordered by a hash part and then by name; the curve itself does not depend on that order. No task
    sorts all companies: they are cut into ranges, one line per range gives what lies before it, and the running
    sums are made within ranges.
    """
    placed = ranged_sizes(sizes)
    ranges = placed.groupBy("range").agg(F.count("*").alias("companies"), F.sum("n").alias("clauses"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.select(
        "range",
        F.coalesce(F.sum("companies").over(before), F.lit(0)).alias("companies_before"),
        F.coalesce(F.sum("clauses").over(before), F.lit(0)).alias("clauses_before"),
        F.sum("clauses").over(Window.partitionBy()).alias("total"),
    )
    within = Window.partitionBy("range").orderBy(*_curve_order())
    sums = placed.select(
        "range",
        "company",
        "n",
        F.row_number().over(within).alias("within"),
        F.sum("n").over(within.rowsBetween(Window.unboundedPreceding, 0)).alias("so_far"),
    ).join(offsets, "range")
    running = F.col("clauses_before") + F.col("so_far")
    return sums.select(
        (F.col("companies_before") + F.col("within")).alias("rank"),
        "company",
        "n",
        running.alias("running"),
        (F.lit(100.0) * running / F.col("total")).alias("running_pct"),
    )


def _curve_order() -> list[Column]:
    return [F.desc("n"), F.asc("part"), F.asc("company")]


def companies_for_half(sizes: DataFrame) -> DataFrame:
    """How many of the largest companies (A19) it takes to hold half of all clauses, and their percentage.

    Within one size the running count grows by that size, so the number of companies below the half
    follows per size by division and no company is ranked.
    """
    counts = sizes.groupBy("n").agg(F.count("*").alias("companies"))
    larger = Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    placed = counts.select(
        "n",
        "companies",
        F.coalesce(F.sum(F.col("n") * F.col("companies")).over(larger), F.lit(0)).alias("before"),
        F.sum(F.col("n") * F.col("companies")).over(everything).alias("total"),
    )
    room = F.expr("(total - 2 * before) div (2 * n)")
    below = F.greatest(F.lit(0), F.least(F.col("companies"), room))
    return placed.agg((F.sum(below) + 1).alias("n_for_half"), F.sum("companies").alias("companies")).withColumn(
        "pct_of_companies", F.try_divide(F.lit(100.0) * F.col("n_for_half"), F.col("companies"))
    )


def label_by_form(rows: DataFrame, weight: str | None = None) -> DataFrame:
    """Rows and share of each form type within a label; a pair without rows has a share of 0 and no row."""
    counts = rows.where(F.col("form_type").isNotNull()).groupBy("label", "form_type").agg(_count(weight).alias("n"))
    total = F.sum("n").over(Window.partitionBy("label"))
    return counts.withColumn("share", F.try_divide(F.col("n").cast("double"), total))


def is_unclassified() -> Column:
    """No industry code, whether NULL, empty or zero."""
    return F.col("sic").isNull() | F.col("sic").isin(UNCLASSIFIED)


def coverage(rows: DataFrame, weight: str | None = None) -> DataFrame:
    """Rows without industry, without date, and without even the fallback year, in one pass."""
    no_date = F.col("filing_date").isNull()
    counted = rows.agg(
        _count(weight).alias("rows"),
        _count(weight, is_unclassified()).alias("missing_sic"),
        _count(weight, no_date).alias("missing_date"),
        _count(weight, no_date & F.col("filing_year").isNull()).alias("missing_year_too"),
    )
    return counted.withColumns(
        {
            "missing_sic_pct": F.try_divide(F.lit(100.0) * F.col("missing_sic"), F.col("rows")),
            "missing_date_pct": F.try_divide(F.lit(100.0) * F.col("missing_date"), F.col("rows")),
        }
    )


def companies_without_industry(rows: DataFrame, n: int = 5) -> DataFrame:
    """The first companies, by name, whose industry code is stored but says nothing."""
    return rows.where(F.col("sic").isin(UNCLASSIFIED)).select("company").distinct().orderBy("company").limit(n)


def industry_counts(rows: DataFrame, weight: str | None = None) -> DataFrame:
    """Clauses per industry, unclassified codes excluded, with all ``rows`` and the percentage of them.

    One pass: excluded rows fall into a NULL group, which counts for the total and is then dropped.
    The total is taken over one line per industry.
    """
    stated = F.when(~F.coalesce(F.col("sic").isin(UNCLASSIFIED), F.lit(False)), F.col("sic_description"))
    counts = rows.groupBy(stated.alias("sic_description")).agg(_count(weight).alias("n"))
    return (
        counts.withColumn("rows", F.sum("n").over(Window.partitionBy()))
        .where(F.col("sic_description").isNotNull())
        .withColumn("pct", F.lit(100.0) * F.col("n") / F.col("rows"))
    )


def top_industries(rows: DataFrame, n: int = 15, weight: str | None = None) -> DataFrame:
    """The largest industries."""
    return industry_counts(rows, weight).orderBy(F.desc("n"), "sic_description").limit(n)


def top_industry_share(rows: DataFrame, n: int = 10, weight: str | None = None) -> DataFrame:
    """Percentage of all rows that the largest industries hold."""
    return top_industries(rows, n, weight).agg(F.try_divide(F.lit(100.0) * F.sum("n"), F.max("rows")).alias("top_pct"))


def set_report(sets: DataFrame) -> DataFrame:
    """Per set rows and companies, and per set and label rows (``sets`` has ``set, cik, label``).

    Companies are counted from distinct (set, cik) pairs; totals and labels come from one grouping.
    """
    rows = sets.groupingSets([["set"], ["set", "label"]], "set", "label").agg(
        F.count("*").alias("examples"), F.grouping("label").alias("is_total")
    )
    companies = sets.groupBy("set").agg(F.count_distinct("cik").alias("companies"))
    return rows.join(companies, "set").select(
        "set",
        F.when(F.col("is_total") == 1, F.lit("(all)")).otherwise(F.col("label")).alias("label"),
        "examples",
        F.when(F.col("is_total") == 1, F.col("companies")).otherwise(F.lit(0)).alias("companies"),
    )


def documents_scanned(documents: DataFrame) -> DataFrame:
    """Documents read, with or without clauses (``documents`` has a ``clauses`` array)."""
    return documents.agg(
        F.count("*").alias("documents"),
        F.count_if(F.size("clauses") == 0).alias("without_clauses"),
        F.coalesce(F.sum(F.size("clauses")), F.lit(0)).alias("clauses"),
    )
