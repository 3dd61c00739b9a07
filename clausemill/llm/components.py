"""Connected components of links between numbered things."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clausemill.llm.common import stored

MAX_ROUNDS = 100


def components(links: DataFrame) -> DataFrame:
    """``id`` and ``component``, the smallest id that can be reached, for every end of the links ``a``, ``b``.

    Labels move to neighbours and then jump to the label of their label, so long chains take few rounds. Every
    round is a written table.
    """
    spark = links.sparkSession
    edges = links.selectExpr("a AS id", "b AS other").unionByName(links.selectExpr("b AS id", "a AS other")).distinct()
    edges = stored(spark, edges, "edges")
    labels = stored(spark, edges.groupBy("id").agg(F.least("id", F.min("other")).alias("component")), "labels")
    for _ in range(MAX_ROUNDS):
        of_other = labels.select(F.col("id").alias("other"), F.col("component").alias("theirs"))
        offered = edges.join(of_other, "other").groupBy("id").agg(F.min("theirs").alias("theirs"))
        nearer = labels.join(offered, "id").select(
            "id", F.col("component").alias("before"), F.least("component", "theirs").alias("component")
        )
        step = stored(spark, nearer, "labels")
        jump = step.select(F.col("id").alias("component"), F.col("component").alias("beyond"))
        jumped = step.join(jump, "component", "left").select(
            "id", "before", F.coalesce("beyond", "component").alias("component")
        )
        labels = stored(spark, jumped, "labels")
        if labels.where("component <> before").isEmpty():
            return labels.select("id", "component")
        labels = labels.select("id", "component")
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
