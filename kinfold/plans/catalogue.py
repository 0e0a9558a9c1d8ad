"""All queries of the core, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kinfold.plans import imputation_queries, ingest_queries, matching_queries, report_queries, result_queries, streaming_queries

_MODULES = [ingest_queries, matching_queries, imputation_queries, report_queries, result_queries, streaming_queries]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for m in _MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in _MODULES for k, s in m.SQL.items()}
