"""The operators of this package as queries over the given tables, with SQL where SQL can express them."""

from __future__ import annotations

from clausemill.llm import queries_documents, queries_embeddings, queries_pages, queries_words  # noqa: F401  (they register their queries)
from clausemill.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
