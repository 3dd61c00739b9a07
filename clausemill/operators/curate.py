"""Company split, balanced samples, evaluation candidates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clausemill.functions.ids import SAMPLE_SEED, SPLIT_SEED, ambiguity_score, shuffle_key, split_bucket
from clausemill.functions.taxonomy import CONTRACTS, Taxonomy
from clausemill.operators.topk import first_k
from clausemill.session import scratch_path


# So many chosen rows are fetched by their keys; more are joined.
PUSHED_KEYS = 5000
# So many keys stand in one list of a filter: the longest that ``session.py`` has looked up key by key.
LISTED_KEYS = 64


def assign_buckets(clauses: DataFrame, seed: str = SPLIT_SEED) -> DataFrame:
    """One ``(cik, bucket)`` row per company."""
    return clauses.select("cik").distinct().withColumn("bucket", split_bucket(F.col("cik"), seed))


def in_bucket(clauses: DataFrame, assignments: DataFrame, bucket: str) -> DataFrame:
    """Clauses of the companies that a recorded assignment puts in a bucket."""
    members = assignments.where(F.col("bucket") == bucket).select("cik")
    return clauses.join(members, "cik", "left_semi")


def of_bucket(clauses: DataFrame, bucket: str, seed: str = SPLIT_SEED) -> DataFrame:
    """J4 without a join: the bucket is a function of the company key, so it is a plain filter."""
    return clauses.where(split_bucket(F.col("cik"), seed) == bucket)


def picked(candidates: DataFrame, picked_ids: DataFrame) -> DataFrame:
    """Candidates a reviewer chose."""
    return candidates.join(picked_ids.select("clause_id"), "clause_id", "left_semi")


def sample_pool(clauses: DataFrame, per_category: int, company_cap: int, seed: int, taxonomy: Taxonomy) -> DataFrame:
    """The rows that can influence a sample, as short rows: ``ord, cik, clause_id, position, turn``.

    Per label and company only the first ``company_cap`` rows can be picked. Earlier labels pick at
    most ``per_category`` rows each, and each pick blocks at most one row of a later label, so label
    number l (from 0) needs its first ``per_category * (l + 1)`` rows and no more. ``position`` is the
    row's place in its label and ``turn`` its place among the rows of its company there.
    """
    rows = clauses.select(
        "clause_id", "cik", taxonomy.position(F.col("label")).alias("ord"), shuffle_key(F.col("clause_id"), seed).alias("key")
    ).where(F.col("ord") >= 0)
    order = [F.col("key"), F.col("clause_id")]
    capped = first_k(rows, ["ord", "cik"], order, company_cap, "turn")
    return (
        first_k(capped, ["ord"], order, per_category * len(taxonomy.labels), "position")
        .where(F.col("position") <= per_category * (F.col("ord") + 1))
        .select("ord", "cik", "clause_id", "position", "turn")
    )


def sample_picks(
    clauses: DataFrame, per_category: int, company_cap: int, seed: int = SAMPLE_SEED, taxonomy: Taxonomy = CONTRACTS
) -> DataFrame:
    """``(ord, clause_id, position)`` of the sampled rows.

    Labels take turns in reporting order. Within a label rows come in the seeded order, a row is
    passed over when its company already has ``company_cap`` picks under any label, and the label
    stops at ``per_category`` picks. The pool is written once, and each label is one small distributed
    stage whose picks are written to the shared folder, so a lost executor costs one stage.
    """
    spark = clauses.sparkSession
    path, folder = scratch_path(spark, "sample-pool"), scratch_path(spark, "sample-picks")
    pool = sample_pool(clauses, per_category, company_cap, seed, taxonomy)
    pool.write.partitionBy("ord").parquet(path)
    pool = spark.read.schema(pool.schema).parquet(path)
    names = pool.columns
    drawn = spark.createDataFrame([], pool.schema)
    for ordinal in range(len(taxonomy.labels)):
        used = drawn.groupBy("cik").agg(F.count("*").alias("used"))
        eligible = (
            pool.where(F.col("ord") == ordinal)
            .join(used, "cik", "left")
            .where(F.col("turn") <= company_cap - F.coalesce("used", F.lit(0)))
            .select(*names)
        )
        eligible.orderBy("position").limit(per_category).write.parquet(f"{folder}/stage={ordinal}")
        drawn = spark.read.schema(pool.schema).parquet(*[f"{folder}/stage={done}" for done in range(ordinal + 1)])
    return drawn.select("ord", "clause_id", "position")


def _one_of(name: str, values: set[str], size: int) -> Column:
    """Whether a column is one of some values: lists of a size under a balanced tree, so that no scan recurses deeply."""
    quoted = [value.replace("\\", "\\\\").replace("'", "\\'") for value in sorted(values)]
    lists = [quoted[at : at + size] for at in range(0, len(quoted), size)]
    found = [F.expr(f"{name} IN ({', '.join(f"'{value}'" for value in part)})") for part in lists]
    while len(found) > 1:
        found = [reduce(Column.__or__, found[at : at + 2]) for at in range(0, len(found), 2)]
    return found[0]


def _keys(rows: DataFrame) -> list[str]:
    """The id, and the accession number by which stored rows are sorted, where rows have one."""
    return [name for name in ("clause_id", "accession") if name in rows.columns]


def rows_of(clauses: DataFrame, chosen: DataFrame, computed: bool = False) -> DataFrame:
    """The wide rows of chosen ids, with the columns of ``chosen`` (``clause_id``, perhaps ``accession``, and any others).

    Up to ``PUSHED_KEYS`` keys become a filter of the scan, which a stored table answers from its statistics, page
    indexes and Bloom filters; beyond that many, the rows are joined by the size of the chosen table. Keys that are
    ``computed``, not stored, meet one list, since each list repeats their expression and many outgrow a compiled method.
    """
    names = _keys(chosen)
    keys = chosen.select(*names).limit(PUSHED_KEYS + 1).collect()
    if not keys:
        return clauses.join(chosen.drop("accession"), "clause_id").where(F.lit(False))
    if len(keys) <= PUSHED_KEYS:
        for name in names:
            if any(key[name] is None for key in keys):
                continue
            clauses = clauses.where(_one_of(name, {key[name] for key in keys}, PUSHED_KEYS if computed else LISTED_KEYS))
    return clauses.join(chosen.drop("accession"), "clause_id")


def _stored(rows: DataFrame, name: str) -> DataFrame:
    path = scratch_path(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def pool(clauses: DataFrame, bucket: Column, taxonomy: Taxonomy = CONTRACTS) -> DataFrame:
    """What choosing needs of the store, in one narrow scan: keys, label, score and the ``bucket`` of the company."""
    return with_ambiguity(
        clauses.select(*_keys(clauses), "cik", "label", "section_header", "text_len", bucket.alias("bucket")), taxonomy
    ).drop("section_header", "text_len")


def stratified_sample(
    clauses: DataFrame, per_category: int, company_cap: int, seed: int = SAMPLE_SEED, taxonomy: Taxonomy = CONTRACTS, computed: bool = False
) -> DataFrame:
    """The sampled clauses, whole rows with ``ord`` and ``position``. ``clause_id`` must be unique; ``computed`` as in ``rows_of``.

    The choice runs on keys, in one narrow scan; the texts are read for the chosen rows only.
    """
    narrow = _stored(clauses.select(*_keys(clauses), "cik", "label"), "pool")
    picks = sample_picks(narrow, per_category, company_cap, seed, taxonomy)
    return rows_of(clauses, _stored(with_accession(picks, narrow), "picks"), computed)


def with_accession(chosen: DataFrame, narrow: DataFrame) -> DataFrame:
    """Chosen ids with the accession number by which stored rows are sorted."""
    return narrow.select(*_keys(narrow)).join(chosen, "clause_id")


def shortfall(spark, sampled: DataFrame, per_category: int, taxonomy: Taxonomy = CONTRACTS) -> DataFrame:
    """C4: per label how many examples were wanted and found."""
    found = sampled.groupBy("label").agg(F.count("*").alias("found"))
    return (
        taxonomy.table(spark)
        .select("ord", "label")
        .join(found, "label", "left")
        .select(
            "ord",
            "label",
            F.lit(per_category).alias("wanted"),
            F.coalesce("found", F.lit(0)).alias("found"),
            (F.coalesce("found", F.lit(0)) < per_category).alias("short"),
        )
    )


def with_ambiguity(clauses: DataFrame, taxonomy: Taxonomy = CONTRACTS) -> DataFrame:
    """P10, F2: add ``ambiguity_score``."""
    return clauses.withColumn("ambiguity_score", ambiguity_score(F.col("section_header"), F.col("text_len"), taxonomy))


def best_candidates(narrow: DataFrame, per_category: int, taxonomy: Taxonomy = CONTRACTS) -> DataFrame:
    """``clause_id, accession, ord, rank`` of the most ambiguous clauses per label, of rows with their score."""
    scored = narrow.select(*_keys(narrow), taxonomy.position(F.col("label")).alias("ord"), "ambiguity_score")
    order = [F.desc("ambiguity_score"), F.asc("clause_id")]
    return first_k(scored.where(F.col("ord") >= 0), ["ord"], order, per_category).select(*_keys(narrow), "ord", "rank")


def evaluation_candidates(clauses: DataFrame, per_category: int, taxonomy: Taxonomy = CONTRACTS) -> DataFrame:
    """Per label the ``per_category`` most ambiguous clauses, whole rows with ``ord`` and ``rank``."""
    chosen = best_candidates(pool(clauses, F.lit(None).cast("string"), taxonomy), per_category, taxonomy)
    return rows_of(clauses, _stored(chosen, "candidates"))


def example_picks(clauses: DataFrame, by: tuple[str, ...] = (), seed: int = 1) -> DataFrame:
    """Id and random ``key`` of one seeded random clause per label (and ``by``)."""
    rows = clauses.select(*by, "label", *_keys(clauses), shuffle_key(F.col("clause_id"), seed).alias("key"))
    return first_pick(rows, by)


def first_pick(picks: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Of the picks of parts, the one per label (and ``by``) that the whole has."""
    return first_k(picks, [*by, "label"], [F.col("key"), F.col("clause_id")], 1).select(*by, "label", *_keys(picks), "key")


def examples_of(clauses: DataFrame, picks: DataFrame) -> DataFrame:
    """The picked clauses with the start of their text."""
    return rows_of(clauses, _stored(picks.select(*_keys(picks)), "examples")).select(
        "label", "company", "section_header", "clause_id", F.substring("text", 1, 300).alias("excerpt")
    )


def one_per_label(clauses: DataFrame, seed: int = 1) -> DataFrame:
    """One seeded random clause per label with the start of its text."""
    return examples_of(clauses, example_picks(clauses, seed=seed))
