"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clausemill.session import scratch_path

# What separates words, and a word.
GAP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it.

    A column that a lambda captures is otherwise inlined and computed anew for every element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def whole(text: Column | str) -> Column:
    """A text, empty where it is null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text: Column) -> Column:
    """The words of a whole text, in order."""
    return F.array_remove(F.split(text, GAP), "")


def row_key(*columns: str) -> Column:
    """A digest of some columns that tells rows apart, nulls included.

    Rows that agree in all of them have one key; what is decided by key holds for each of them.
    """
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("!")) for c in columns]
    lengths = [F.length(p).cast("string") for p in parts]
    return F.unhex(F.md5(F.concat_ws(":", *lengths, *parts)))


def stored(spark: SparkSession, rows: DataFrame, name: str) -> DataFrame:
    """Rows written to the shared folder and read again: computed once, and safe from lost executors."""
    path = scratch_path(spark, name)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
