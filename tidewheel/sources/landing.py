"""Landing JSON files whose fields change: a logged schema, and a map for what does not fit it.

Each start reads the newest logged schema. Every line becomes a row of its columns; fields the schema
does not know, and values that cannot be cast to its types, land as text in ``_rescued``. When the
files at hand are through, unknown fields are given a type and logged as the next version of the schema,
which the next start takes up. Reading fills a column from ``_rescued`` where an earlier version did not
know it yet. No row and no value is lost, and nothing stops for a new field or a changed type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.streaming.jobs import drain

_LOG = "version INT, place INT, name STRING, type STRING"
RESCUED, BROKEN = "_rescued", "_line"


def log_schema(spark: SparkSession, root: str, version: int, columns: dict[str, str]) -> None:
    rows = [(version, k, name, kind) for k, (name, kind) in enumerate(columns.items())]
    spark.createDataFrame(rows, _LOG).coalesce(1).write.mode("overwrite").parquet(f"{root}/schema/at={version}")


def logged_schema(spark: SparkSession, root: str) -> tuple[int, dict[str, str]]:
    """Newest version of the schema and its columns, in order."""
    log = spark.read.schema(_LOG).parquet(f"{root}/schema")
    version = log.agg(F.max("version")).first()[0]
    rows = log.where(F.col("version") == version).sort("place").collect()
    return version, {r["name"]: r["type"] for r in rows}


def shaped(lines: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Rows of ``columns`` and ``_rescued`` from JSON lines in ``value``.

    A line that is no JSON object lands whole in ``_rescued`` under ``_line``.
    """
    fields = F.from_json("value", "map<string,string>")
    held = lines.select(F.coalesce(fields, F.create_map(F.lit(BROKEN), F.col("value"))).alias("_f"))

    def misfit(name: Column, value: Column) -> Column:
        fits = F.lit(False)
        for column, kind in columns.items():
            fits = fits | ((name == column) & (value.isNull() | value.try_cast(kind).isNotNull()))
        return ~fits

    return held.select(
        *[F.col("_f")[c].try_cast(kind).alias(c) for c, kind in columns.items()],
        F.map_filter("_f", misfit).alias(RESCUED),
    )


def _typed_fields(rescued: DataFrame, known: dict[str, str]) -> dict[str, str]:
    """A type for each unknown field: the narrowest of BIGINT, DOUBLE, STRING that takes all its values."""
    fields = rescued.select(F.explode(RESCUED).alias("name", "value")).where(~F.col("name").isin([*known, BROKEN]))
    lost = [F.count_if(F.col("value").isNotNull() & F.col("value").try_cast(k).isNull()).alias(k) for k in ("bigint", "double")]
    found = fields.groupBy("name").agg(*lost).sort("name").collect()  # one row per unknown field
    return {r["name"]: "bigint" if not r["bigint"] else "double" if not r["double"] else "string" for r in found}


def land(spark: SparkSession, inbox: str, root: str) -> None:
    """Take in the files of ``inbox`` not seen before, with the schema logged under ``root``."""
    version, columns = logged_schema(spark, root)
    rows = shaped(spark.readStream.text(inbox), columns)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/rows/version={version}/batch_id={batch_id}")

    drain(rows, write, f"{root}/checkpoint")
    new = _typed_fields(_rows(spark, root, columns), columns)
    if new:
        log_schema(spark, root, version + 1, columns | new)


def _rows(spark: SparkSession, root: str, columns: dict[str, str]) -> DataFrame:
    ddl = ", ".join(f"`{c}` {kind}" for c, kind in columns.items())
    schema = f"{ddl}, `{RESCUED}` MAP<STRING, STRING>, version INT, batch_id BIGINT"
    return spark.read.schema(schema).option("basePath", f"{root}/rows").parquet(f"{root}/rows").drop("version", "batch_id")


def read_landed(spark: SparkSession, root: str) -> DataFrame:
    """All rows in the newest schema, and ``_rescued`` with what still does not fit it."""
    _, columns = logged_schema(spark, root)
    rows = _rows(spark, root, columns)
    taken = lambda name, value: F.coalesce(
        F.element_at(F.create_map(*[x for c, k in columns.items() for x in (F.lit(c), value.try_cast(k).isNotNull())]), name), F.lit(False)
    )
    return rows.select(
        *[F.coalesce(c, F.col(RESCUED)[c].try_cast(kind)).alias(c) for c, kind in columns.items()],
        F.map_filter(RESCUED, lambda name, value: ~taken(name, value)).alias(RESCUED),
    )
