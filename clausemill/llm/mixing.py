"""Mixing sources to target weights by Pfair scheduling (operator 3), with DataFrame functions only.

Rows of a source are cut into blocks. A source with ``p`` of ``P`` parts gives block number k the release time
floor(k P / p) and the deadline ceil((k + 1) P / p); in every slot the released block with the earliest deadline
goes first. As the parts add up to P, no deadline is missed and each source is less than one block away from its
weight after every slot.

The schedule repeats every P slots. One period, bounded by the weights and not by the data, is scheduled by a fold;
every other block follows by arithmetic, and so does its place in the final order: for each source, how many
rows it has before a slot is known from its number of rows. No window spans a source: rows are numbered inside
many small parts of each source, so a source with a third of all rows is spread like the others.

A source that runs out leaves its slots to the others. No row is dropped. Sources without parts of their own,
null included, share the group ``None`` of the weights. Rows of a source are ordered by a seeded digest of
``doc_id``, then by the other key columns; rows that agree in all of these are interchangeable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clausemill.llm.common import let

BLOCK_ROWS = 64
PART_ROWS = 1024  # rows that are numbered in one window, about, until a source has MAX_RANGES windows
MAX_RANGES = 1 << 16
MAX_PARTS = 100_000  # the sum of all weights: the length of a period


def period(spark: SparkSession, parts: dict[str | None, int]) -> DataFrame:
    """One period of the schedule: ``member``, ``k`` (its block), ``slot``, ``release``, ``deadline``, ``before``.

    ``before`` holds, for each member, how many of its blocks stand in earlier slots of the period.
    """
    weights, total = list(parts.values()), sum(parts.values())
    if min(weights, default=0) < 1 or total > MAX_PARTS:
        raise ValueError(f"weights must be at least 1 and add up to at most {MAX_PARTS}")
    p = F.array(*(F.lit(w) for w in weights))
    members = F.sequence(F.lit(0), F.lit(len(weights) - 1))

    def release(m: Column, k: Column) -> Column:
        return F.floor(k * total / p[m]).cast("int")

    def deadline(m: Column, k: Column) -> Column:
        return F.ceil((k + 1) * total / p[m]).cast("int")

    def step(state: Column, slot: Column) -> Column:
        done = state["done"]
        waiting = F.transform(
            members,
            lambda m: F.when(
                (done[m] < p[m]) & (release(m, done[m]) <= slot), F.struct(deadline(m, done[m]).alias("d"), m.alias("m"))
            ),
        )

        def go(first: Column) -> Column:
            taken = F.struct(first.alias("member"), done[first].alias("k"), slot.alias("slot"), done.alias("before"))
            return F.struct(
                F.transform(done, lambda n, m: F.when(m == first, n + 1).otherwise(n)).alias("done"),
                F.array_append(state["slots"], taken).alias("slots"),
            )

        return let(F.array_min(waiting)["m"], go)

    kind = "struct<done:array<int>,slots:array<struct<member:int,k:int,slot:int,before:array<int>>>>"
    start = F.struct(
        F.array_repeat(F.lit(0), len(weights)).alias("done"),
        F.array().cast("array<struct<member:int,k:int,slot:int,before:array<int>>>").alias("slots"),
    ).cast(kind)
    slots = F.aggregate(F.sequence(F.lit(0), F.lit(total - 1)), start, lambda a, b: step(a, b).cast(kind), lambda a: a["slots"])
    return (
        spark.range(1)
        .select(F.inline(slots))
        .withColumns({"release": release(F.col("member"), F.col("k")), "deadline": deadline(F.col("member"), F.col("k"))})
    )


def mix(
    docs: DataFrame,
    parts: dict[str | None, int],
    source: str = "source",
    keys: tuple[str, ...] = ("doc_id",),
    block_rows: int = BLOCK_ROWS,
    seed: str = "mix",
) -> DataFrame:
    """Each row as ``row`` with its member, block, release, deadline, slot and ``position`` in the mix, from 0.

    Times and slots are counted from the start of the stream, in blocks.
    """
    spark = docs.sparkSession
    parts = {**parts, None: parts.get(None, 1)}
    names, total = list(parts), sum(parts.values())
    member = F.lit(names.index(None))
    for at, name in enumerate(names):
        if name is not None:
            member = F.when(F.col("row")[source].cast("string") == name, at).otherwise(member)
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("row")[keys[0]].cast("string"), F.lit(""))))
    rows = docs.select(F.struct("*").alias("row")).select(
        "row", member.alias("member"), digest.alias("digest"), F.conv(F.substring(digest, 1, 6), 16, 10).cast("long").alias("at")
    )

    # At most one entry for each weight, so both this and the period may be broadcast.
    counts = rows.groupBy("member").agg(F.count("*").alias("n")).groupBy()
    sizes = counts.agg(F.map_from_entries(F.collect_list(F.struct("member", "n"))).alias("sizes"))
    sizes = F.broadcast(sizes.select(F.explode(F.map_keys("sizes")).alias("member"), "sizes"))
    ranges = F.least(F.ceil(F.element_at("sizes", F.col("member")) / PART_ROWS), F.lit(MAX_RANGES))
    rows = rows.join(sizes, "member").withColumn("range", F.shiftright(F.col("at") * ranges, 24))
    fine = rows.groupBy("member", "range").agg(F.count("*").alias("n"))
    in_order = Window.partitionBy("member").orderBy("range")
    fine = fine.select("member", "range", (F.sum("n").over(in_order) - F.col("n")).alias("earlier"))
    in_range = Window.partitionBy("member", "range").orderBy("digest", *(F.col("row")[k].asc_nulls_first() for k in keys))
    weights = F.array(*(F.lit(w).cast("long") for w in parts.values()))
    rows = (
        rows.withColumn("n_before", F.row_number().over(in_range) - 1)
        .join(fine, ["member", "range"])
        .withColumn("rank", F.col("earlier") + F.col("n_before"))
        .withColumn("block", F.floor(F.col("rank") / block_rows))
        .withColumn("round", F.floor(F.col("block") / weights[F.col("member")]))
        .withColumn("k", (F.col("block") % weights[F.col("member")]).cast("int"))
        .join(F.broadcast(period(spark, parts)), ["member", "k"])
    )
    rows_before = F.transform(
        weights,
        lambda w, m: F.least(
            F.coalesce(F.element_at("sizes", m), F.lit(0).cast("long")), (F.col("round") * w + F.col("before")[m]) * block_rows
        ),
    )
    start = F.aggregate(rows_before, F.lit(0).cast("long"), lambda x, y: x + y)
    return rows.select(
        "row",
        "member",
        "rank",
        "block",
        (F.col("round") * total + F.col("release")).alias("release"),
        (F.col("round") * total + F.col("deadline")).alias("deadline"),
        (F.col("round") * total + F.col("slot")).alias("slot"),
        (start + F.col("rank") % block_rows).alias("position"),
    )


def mixed(docs: DataFrame, parts: dict[str | None, int], **options) -> DataFrame:
    """All documents in the columns they came with, in files that follow the mixed order."""
    rows = mix(docs, parts, **options).select("row", "position")
    return rows.repartitionByRange("position").sortWithinPartitions("position").select("row.*")
