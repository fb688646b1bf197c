"""All queries of the core, by name, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import footprint_queries, fragment_queries, geometry_queries, rank_queries, report_queries, text_queries
from .sql import rounded

MODULES = [rank_queries, footprint_queries, geometry_queries, fragment_queries, report_queries, text_queries]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for m in MODULES for f in m.QUERIES}


def oracle_sql() -> dict[str, str]:
    return {name: rounded(sql) for m in MODULES for name, sql in m.SQL.items()}
