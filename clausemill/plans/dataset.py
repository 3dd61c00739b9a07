"""Enriched store to leak-free train, validation and evaluation sets."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clausemill.functions.ids import SAMPLE_SEED, SPLIT_SEED, split_bucket
from clausemill.functions.taxonomy import CONTRACTS, Taxonomy
from clausemill.operators.checks import misplaced, shared_companies, unknown_buckets
from clausemill.operators.curate import (
    assign_buckets,
    best_candidates,
    picked,
    pool,
    rows_of,
    sample_picks,
    shortfall,
    with_accession,
    with_ambiguity,
)
from clausemill.operators.enrich import ENRICHED_COLUMNS
from clausemill.operators.profile import set_report
from clausemill.session import scratch_path
from clausemill.sources import schemas
from clausemill.sources.tables import read_assignments, read_json_lines, write_assignments, write_json_lines


@dataclass(frozen=True)
class SetSizes:
    """Examples per category and picks per company."""

    train_per_category: int = 100
    train_company_cap: int = 10
    val_per_category: int = 15
    val_company_cap: int = 5
    eval_per_category: int = 8


@dataclass(frozen=True)
class DatasetResult:
    """A26 per set and label, and C4 per set: what was wanted and found."""

    report: DataFrame
    shortfall: DataFrame


def curated_sets(
    store: DataFrame,
    sizes: SetSizes = SetSizes(),
    seed: int = SAMPLE_SEED,
    taxonomy: Taxonomy = CONTRACTS,
    split_seed: str = SPLIT_SEED,
    assignments: DataFrame | None = None,
    texts: Callable[[DataFrame], DataFrame] | None = None,
    computed: bool = False,
) -> dict[str, DataFrame]:
    """The three sets as DataFrames, ordered by label turn and pick.

    Companies belong to the buckets of a recorded split, if ``assignments`` has one, else to those of ``split_seed``.
    The store is scanned once, narrowly, for the keys of all sets, and read once for the rows that they chose; both
    are written to the shared folder. Where the store comes without its texts, ``texts`` gives the chosen rows theirs.
    ``computed`` is that of ``rows_of``.
    """
    spark = store.sparkSession
    if assignments is None:
        narrow = pool(store, split_bucket(F.col("cik"), split_seed), taxonomy)
    else:
        narrow = pool(store, F.lit(None).cast("string"), taxonomy).drop("bucket").join(assignments.select("cik", "bucket"), "cik")
    narrow_path, rows_path = scratch_path(spark, "pool"), scratch_path(spark, "set-rows")
    narrow.write.partitionBy("bucket").parquet(narrow_path)
    narrow = spark.read.schema(narrow.schema).parquet(narrow_path)

    def members(bucket: str) -> DataFrame:
        return narrow.where(F.col("bucket") == bucket)

    def sampled(bucket: str, per_category: int, company_cap: int) -> DataFrame:
        picks = sample_picks(members(bucket), per_category, company_cap, seed, taxonomy)
        return with_accession(picks, members(bucket)).select("clause_id", "accession", "ord", F.col("position").alias("place"), F.lit(bucket).alias("set"))

    candidates = best_candidates(members("test"), sizes.eval_per_category, taxonomy)
    chosen = (
        sampled("train", sizes.train_per_category, sizes.train_company_cap)
        .unionByName(sampled("val", sizes.val_per_category, sizes.val_company_cap))
        .unionByName(candidates.select("clause_id", "accession", "ord", F.col("rank").alias("place"), F.lit("test").alias("set")))
    )
    chosen_path = scratch_path(spark, "set-keys")
    chosen.write.parquet(chosen_path)
    rows = rows_of(store, spark.read.schema(chosen.schema).parquet(chosen_path), computed)
    if texts is not None:
        rows = texts(rows)
    rows.write.partitionBy("set").parquet(rows_path)
    rows = spark.read.schema(rows.schema).parquet(rows_path)

    def drawn(bucket: str) -> DataFrame:
        return rows.where(F.col("set") == bucket).orderBy("ord", "place")

    return {
        "train": drawn("train").select(*ENRICHED_COLUMNS),
        "val": drawn("val").select(*ENRICHED_COLUMNS),
        "eval_candidates": with_ambiguity(drawn("test"), taxonomy).select(*ENRICHED_COLUMNS, "ambiguity_score"),
    }


def labelled_sets(sets: dict[str, DataFrame]) -> DataFrame:
    """The sets' keys under one another, with the name of the set."""
    parts = [rows.select(F.lit(name).alias("set"), "clause_id", "cik", "label") for name, rows in sets.items()]
    together = parts[0]
    for part in parts[1:]:
        together = together.unionByName(part)
    return together


class LeakError(ValueError):
    """A company is found in two sets, or in a set it is not assigned to."""


def check_sets(sets: DataFrame, assignments: DataFrame) -> None:
    """Raise unless the sets are disjoint by company and agree with the split."""
    for problem, rows in (
        ("companies in more than one set", shared_companies(sets)),
        ("assignments outside the split", unknown_buckets(assignments)),
        ("rows outside their bucket", misplaced(sets, assignments)),
    ):
        examples = rows.limit(5).collect()
        if examples:
            raise LeakError(f"{problem}: {[row.asDict() for row in examples]}")


def build_dataset(
    spark: SparkSession,
    store: DataFrame,
    out: str,
    sizes: SetSizes = SetSizes(),
    seed: int = SAMPLE_SEED,
    split_seed: str = SPLIT_SEED,
    assignments: DataFrame | None = None,
    picked_ids: DataFrame | None = None,
) -> DatasetResult:
    """Draw the sets, check them, write them, and return the reports.

    ``assignments`` is a recorded split that takes the place of the seed's. The evaluation set holds the
    candidates whose ids a reviewer picked; before there are ``picked_ids`` it is neither written nor reported.
    The sets are written to the shared folder, with the place of each row, before they are checked. Nothing is written to ``out`` when a check fails.
    """
    split_path = scratch_path(spark, "assignments")
    write_assignments(assign_buckets(store, split_seed) if assignments is None else assignments, split_path)
    recorded = read_assignments(spark, split_path)
    drawn = curated_sets(store, sizes, seed, split_seed=split_seed, assignments=None if assignments is None else recorded)
    sets = {}
    for name, rows in drawn.items():
        placed, path = rows.withColumn("_place", F.monotonically_increasing_id()), scratch_path(spark, name)
        placed.write.parquet(path)
        sets[name] = spark.read.schema(placed.schema).parquet(path)
    together = labelled_sets({"eval" if name == "eval_candidates" else name: rows for name, rows in sets.items()})
    check_sets(together, recorded)
    write_assignments(recorded, f"{out}/assignments")
    for name, rows in sets.items():
        write_json_lines(rows.orderBy("_place").drop("_place"), f"{out}/{name}.jsonl")
    written = {name: read_json_lines(spark, f"{out}/{name}.jsonl") for name in ("train", "val")}
    if picked_ids is not None:
        candidates = read_json_lines(spark, f"{out}/eval_candidates.jsonl", schemas.CANDIDATES)
        write_json_lines(picked(candidates, picked_ids), f"{out}/eval.jsonl")
        written["eval"] = read_json_lines(spark, f"{out}/eval.jsonl", schemas.CANDIDATES)
    wanted = {"train": sizes.train_per_category, "val": sizes.val_per_category}
    missing = [shortfall(spark, written[name], n).withColumn("set", F.lit(name)) for name, n in wanted.items()]
    return DatasetResult(set_report(labelled_sets(written)), missing[0].unionByName(missing[1]))
