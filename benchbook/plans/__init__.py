"""The registry of queries with their SQL."""

from benchbook.plans import batch_queries, search_queries, source_queries, text_queries, write_queries  # noqa: F401
from benchbook.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
