"""Registered queries of the reconciliation operators over the driver's tables, each with its DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import entities, release, sources, texts, views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
for _module in (entities, release, sources, texts, views):
    QUERIES |= _module.QUERIES
    ORACLE_SQL |= _module.ORACLE_SQL
