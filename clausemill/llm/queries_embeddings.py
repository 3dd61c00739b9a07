"""Queries over ``embeddings``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clausemill.llm import norm_topk
from clausemill.llm.common import stored, table
from clausemill.llm.registry import query

TOP = 20
TOP_SQL = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({norm_topk.SCALE} * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
      FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= {TOP}
"""


@query("op5_norm_topk", TOP_SQL)
def op5_norm_topk(spark: SparkSession, folder: str) -> DataFrame:
    """For every vector whose id is divisible by 20, the 20 others with the highest inner product."""
    vectors = stored(spark, norm_topk.whole_vectors(table(spark, folder, "embeddings")), "vectors")
    return norm_topk.top_k(vectors, vectors.where("vec_id % 20 = 0"), TOP)
