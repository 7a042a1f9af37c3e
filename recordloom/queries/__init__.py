"""Registered queries with their DuckDB counterparts, one module per family."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import assembly, catalogue, checks, records, tables, text

FAMILIES = [text, catalogue, tables, records, checks, assembly]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: q for family in FAMILIES for name, q in family.FAMILY.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for family in FAMILIES for name, sql in family.FAMILY.ORACLES.items()}
