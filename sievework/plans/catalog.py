"""All queries over the driver's tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chat_queries, file_queries, profile_queries, record_queries, run_queries, similarity_queries

_MODULES = (chat_queries, profile_queries, similarity_queries, record_queries, file_queries, run_queries)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {name: q for m in _MODULES for name, q in m.QUERIES.items()}
ORACLE: dict[str, str] = {name: sql for m in _MODULES for name, sql in m.ORACLE.items()}
FLAGSHIP = "similarity_top_matches"
