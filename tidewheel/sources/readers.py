"""Readers: tables, files with a declared schema, generated rows, and new files only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """One Parquet table of a folder that holds a table per ``<name>.parquet``."""
    return spark.read.parquet(f"{base}/{name}.parquet")


def read_files(
    spark: SparkSession,
    path: str,
    fmt: str,
    schema: T.StructType | str | None = None,
    **options: object,
) -> DataFrame:
    """CSV, JSON or Parquet files. Without ``schema`` the reader infers one (an extra pass)."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    elif fmt == "csv":
        reader = reader.option("inferSchema", True)
    return reader.load(path)


def rows(spark: SparkSession, values: Sequence[tuple], schema: str) -> DataFrame:
    """Small literal table with a declared DDL schema."""
    return spark.createDataFrame(list(values), schema)


def generated(spark: SparkSession, n: int, columns: dict[str, Column]) -> DataFrame:
    """``n`` rows made on the executors; ``columns`` are expressions over ``id``."""
    return spark.range(n).select("id", *[expr.alias(name) for name, expr in columns.items()])


def new_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    fmt: str = "parquet",
    **options: object,
) -> DataFrame:
    """Streaming read of a folder: each run picks up files its checkpoint has not seen."""
    return spark.readStream.format(fmt).schema(schema).options(**options).load(path)


def table_stream(spark: SparkSession, base: str, name: str, schema: T.StructType | str) -> DataFrame:
    """One table of a folder as a stream. The path is a pattern, so that the table may be a
    folder of files or a single file (a plain path must be a folder)."""
    return new_files(spark, f"{base}/{name}.parque[t]", schema)
