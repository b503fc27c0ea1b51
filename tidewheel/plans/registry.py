"""Registry of named queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewheel.sources.readers import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The Parquet tables of one folder as attributes: ``Tables(spark, path).orders``."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base
        self._read: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = read_table(self.spark, self.base, name)
        return self._read[name]


def query(name: str, sql: str | None = None):
    """Register ``fn(tables)`` under ``name``, with the SQL that must give the same rows."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, base: fn(Tables(spark, base))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register
