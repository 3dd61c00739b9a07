"""Exact top-k search by inner product with norm-bucketed retrieval (operator 5).

Candidates are grouped by length (norm) into buckets. A query with a proven lower bound t for its k-th best score
needs a bucket only if t <= |query| * (the bucket's largest length): the scores against the longest vectors give
that bound first. Inside a bucket, t / (|query| * largest length) is a local cosine threshold. If it is high, a
candidate must agree with the query in its largest coordinates (coordinate pruning); if it is low, only the
bucket's longer vectors can reach t (length pruning). Products of what remains are computed in whole numbers and
verified against t. Nothing is estimated, so results are exact.

Work is dealt in cells of a block of candidates and a block of queries. Buckets are cut into blocks by a hash of
the id, so equal lengths, or a vector that a third of all rows share, are spread like any others.

Vectors are turned into floor(scale * x). Those that are null or hold null or non-finite components take no part,
and rows without an id neither. A repeated id takes part once, with its smallest vector. Shorter vectors are
filled up with zeros. Whole numbers are exact up to 2^53; where products may exceed that, they are computed with
Python's integers and scores are limited to the range of long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SCALE = 64
BUCKETS = 16
BLOCK_ROWS = 4096
QUERY_ROWS = 1024
SEED_ROWS = 2048  # the longest vectors, which give each query its first bound
COORDINATE_FROM = 0.6  # local cosine threshold from which coordinates prune better than lengths
FOCUS = 3  # coordinates that are looked at

_PAIRS = "query_id long, vec_id long, score long"


def whole_vectors(vectors: DataFrame, vector: str = "embedding", key: str = "vec_id", scale: int = SCALE) -> DataFrame:
    """``vec_id``, ``vector`` (array of long) and ``norm`` of the rows that take part."""
    x = F.col(vector).cast("array<double>")
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), x.alias("x")).where(F.col("vec_id").isNotNull() & F.col("x").isNotNull())
    rows = rows.where(~F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))))
    rows = rows.select("vec_id", F.transform("x", lambda v: F.floor(v * scale)).alias("vector"))
    rows = rows.groupBy("vec_id").agg(F.min("vector").alias("vector"))
    squares = F.aggregate("vector", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))
    return rows.withColumn("norm", F.sqrt(squares))


def _matrix(vectors: pd.Series, width: int | None = None) -> np.ndarray:
    arrays = [np.asarray(v, dtype=np.int64) for v in vectors]
    width = max([width or 0, *(len(a) for a in arrays)])
    if all(len(a) == width for a in arrays) and arrays:
        return np.stack(arrays)
    out = np.zeros((len(arrays), width), dtype=np.int64)
    for row, a in zip(out, arrays, strict=True):
        row[: len(a)] = a
    return out


def _products(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Exact inner products."""
    largest = [float(np.abs(m.astype(float)).max(initial=0.0)) for m in (queries, candidates)]
    if largest[0] * largest[1] * max(1, queries.shape[1]) < 2.0**53:
        return (queries.astype(np.float64) @ candidates.astype(np.float64).T).astype(np.int64)
    exact = queries.astype(object) @ candidates.astype(object).T
    return np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to smaller ids."""
    if len(scores) > k:
        places = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    else:
        places = np.arange(len(scores))
    return places[np.lexsort((ids[places], -scores[places]))[:k]]


def _bounds(seed_ids: np.ndarray, seeds: np.ndarray, k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch.copy()
            bounds: list[float | None] = []
            if len(batch):
                queries = _matrix(batch["vector"], seeds.shape[1])
                width = queries.shape[1]
                scores = _products(queries, np.pad(seeds, ((0, 0), (0, width - seeds.shape[1]))))
                for own, row in zip(batch["vec_id"], scores, strict=True):
                    others = row[seed_ids != own]
                    bounds.append(float(np.partition(others, len(others) - k)[len(others) - k]) if len(others) >= k else None)
            batch["bound"] = pd.Series(bounds, index=batch.index, dtype="float64")
            yield batch

    return run


def _cell(k: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        asking = rows["is_query"].to_numpy(dtype=bool)
        queries, candidates = rows[asking], rows[~asking].sort_values("norm", ascending=False, kind="stable")
        if queries.empty or candidates.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        width = max(map(len, rows["vector"]))
        q, x = _matrix(queries["vector"], width), _matrix(candidates["vector"], width)
        ids, norms = candidates["vec_id"].to_numpy(), candidates["norm"].to_numpy()
        bound = queries["bound"].fillna(-np.inf).to_numpy(dtype=float)
        length = queries["norm"].to_numpy()
        reach = length * norms[0] * (1 + 1e-9)
        local = np.full(len(q), -1.0)
        positive = (bound > 0) & (reach > 0)
        local[positive] = bound[positive] / reach[positive]
        # With a positive bound, no vector of length bound / |query| or less reaches it.
        needed = np.where(positive, bound / np.maximum(length, 1e-300) * (1 - 1e-9), -1.0)
        prefix = np.searchsorted(-norms, -needed, side="right")
        prefix[(bound > 0) & (reach <= 0)] = 0
        found: list[tuple[int, np.ndarray, np.ndarray]] = []

        def keep(at: int, scores: np.ndarray, of: np.ndarray) -> None:
            own = queries["vec_id"].iat[at]
            good = (scores >= bound[at]) & (of != own)
            scores, of = scores[good], of[good]
            chosen = _best(scores, of, k)
            found.append((own, of[chosen], scores[chosen]))

        by_coordinate = np.flatnonzero((local >= COORDINATE_FROM) & (local <= 1) & (prefix > 0))
        by_length = np.flatnonzero((local < COORDINATE_FROM) & (prefix > 0))
        if len(by_length):
            scores = _products(q[by_length], x[: prefix[by_length].max()])
            for at, row in zip(by_length, scores, strict=True):
                keep(at, row[: prefix[at]], ids[: prefix[at]])
        if len(by_coordinate):
            unit = x / np.maximum(norms, 1e-300)[:, None]
        for at in by_coordinate:
            direction, t = q[at] / length[at], local[at]
            fits = np.ones(prefix[at], dtype=bool)
            for f in np.argsort(-np.abs(direction))[:FOCUS]:
                # Unit vectors with cosine t or more have their coordinate within this interval.
                slack = np.sqrt(max(0.0, (1 - t * t) * (1 - direction[f] ** 2)))
                low, high = t * direction[f] - slack, t * direction[f] + slack
                c = unit[: prefix[at], f]
                if direction[f] < t:  # else the interval reaches up to 1
                    fits &= c <= high + 1e-9
                if direction[f] > -t:  # else it reaches down to -1
                    fits &= c >= low - 1e-9
            places = np.flatnonzero(fits)
            if len(places):
                keep(at, _products(q[at : at + 1], x[places])[0], ids[places])
        return pd.DataFrame(
            {
                "query_id": np.repeat([f[0] for f in found], [len(f[1]) for f in found]).astype("int64"),
                "vec_id": np.concatenate([f[1] for f in found] or [[]]).astype("int64"),
                "score": np.concatenate([f[2] for f in found] or [[]]).astype("int64"),
            }
        )

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """Each query's k best candidates as ``query_id``, ``rank``, ``vec_id``, ``score``; its own id is no candidate.

    Both sides come from ``whole_vectors``.
    """
    # Bounded by SEED_ROWS.
    longest = vectors.orderBy(F.desc("norm"), "vec_id").limit(SEED_ROWS).select("vec_id", "vector").toPandas()
    if longest.empty:
        return queries.limit(0).selectExpr("vec_id AS query_id", "1 AS rank", "vec_id", "vec_id AS score")
    bounded = queries.mapInPandas(
        _bounds(longest["vec_id"].to_numpy(), _matrix(longest["vector"]), k), "vec_id long, vector array<long>, norm double, bound double"
    )
    # At most BUCKETS rows each.
    cuts = sorted(set(vectors.approxQuantile("norm", [i / BUCKETS for i in range(1, BUCKETS)], 0.001)), reverse=True)
    bucket = sum((F.col("norm") < c).cast("int") for c in cuts) if cuts else F.lit(0)
    vectors = vectors.withColumn("bucket", bucket)
    sizes = sorted(tuple(r) for r in vectors.groupBy("bucket").agg(F.count("*"), F.max("norm")).collect())
    blocks = {b: -(-n // BLOCK_ROWS) for b, n, _ in sizes}
    first = dict(zip(blocks, np.cumsum([0, *blocks.values()]).tolist(), strict=False))
    query_blocks = F.lit(max(1, -(-queries.count() // QUERY_ROWS)))

    def by_bucket(values: dict[int, int]):
        return F.element_at(F.array(*(F.lit(values.get(b, 0)) for b in range(max(values) + 1))), F.col("bucket") + 1)

    candidates = vectors.select(
        "vec_id",
        "vector",
        "norm",
        F.lit(None).cast("double").alias("bound"),
        F.lit(False).alias("is_query"),
        (by_bucket(first) + F.pmod(F.xxhash64("vec_id"), by_bucket(blocks))).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), query_blocks - 1)).alias("query_block"),
    )
    # The longest bucket comes first, so a query needs the blocks of some first buckets.
    needed = sum(
        F.when(F.col("bound").isNull() | (F.col("bound") <= F.col("norm") * F.lit(top * (1 + 1e-9))), blocks[b]).otherwise(0)
        for b, _, top in sizes
    )
    asked = bounded.withColumn("needed", needed).where("needed > 0")
    asked = asked.select(
        "vec_id",
        "vector",
        "norm",
        "bound",
        F.lit(True).alias("is_query"),
        F.explode(F.sequence(F.lit(0), (F.col("needed") - 1).cast("int"))).alias("block"),
        F.pmod(F.xxhash64("vec_id"), query_blocks).cast("int").alias("query_block"),
    )
    found = candidates.unionByName(asked).groupBy("block", "query_block").applyInPandas(_cell(k), _PAIRS)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
