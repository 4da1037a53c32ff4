"""The snapshot queries by name, with their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import check_queries, derived_queries, file_queries, finding_queries, lane_queries, mapping_queries, panel_queries, posting_queries, reference_queries, rule_queries, source_queries, stream_queries

MODULES = (posting_queries, derived_queries, rule_queries, mapping_queries, finding_queries, panel_queries, stream_queries, source_queries, check_queries, reference_queries, file_queries, lane_queries)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for module in MODULES for name, query in module.queries().items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.oracle_sql().items()}
