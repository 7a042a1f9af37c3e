"""Keeping a family's queries beside their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import table


class Tables:
    """The folder's tables as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return table(self.spark, self.folder, name)


class Family:
    def __init__(self):
        self.QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.ORACLES: dict[str, str] = {}

    def query(self, oracle: str | None):
        """Registers a function of Tables under its name, with its counterpart (None: rows only)."""

        def keep(f):
            def run(spark: SparkSession, folder: str) -> DataFrame:
                return f(Tables(spark, folder))

            run.__doc__ = f.__doc__
            self.QUERIES[f.__name__] = run
            if oracle:
                self.ORACLES[f.__name__] = oracle
            return f

        return keep
