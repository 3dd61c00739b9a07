"""The documents of a corpus on their way to training data, as stages over the operators of ``clausemill.llm``.

Every stage reads what its predecessor wrote. All but the last return the columns that they are given; the texts of
kept documents lose failed and boilerplate lines on the way. Nulls, empty tables and repeated rows are treated as
the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clausemill.llm import chosen_path, line_spread, mixing, piece_sampling, quality_rules
from clausemill.llm.common import stored, table
from clausemill.llm.queries_documents import TARGET_PARTS
from clausemill.llm.registry import query


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: rejected documents go, and failed lines of the others."""
    return quality_rules.clean(docs)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: lines that stand on many sites go."""
    return line_spread.clean(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup: one document of each group of near copies stays."""
    return chosen_path.dedup(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: all documents, in the order of the target weights."""
    return mixing.mixed(docs, TARGET_PARTS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece: a sampled segmentation of every document."""
    return piece_sampling.encode(docs, keep=("doc_id", "lang", "source"))


STAGES = [
    ("quality rules", keep_good),
    ("line dedup", drop_boilerplate),
    ("MinHash near-dedup", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", encode),
]

# Sampled segmentations are no matter of SQL; the tests compare the rows with a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for at, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at + 1 < len(STAGES):
            docs = stored(spark, docs, f"stage-{at + 1}")
    return docs


@query("pipeline")
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of ``run``."""
    return run(spark, folder)
