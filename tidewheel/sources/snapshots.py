"""Numbered table versions: one Parquet folder each, and a list of versions beside them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LIST_SCHEMA = "version INT, committed_at TIMESTAMP_NTZ, operation STRING"


def _data(root: str, version: int) -> str:
    return f"{root}/v={version}"


def versions(spark: SparkSession, root: str) -> DataFrame:
    """(version, committed_at, operation) for every committed version."""
    return spark.read.schema(_LIST_SCHEMA).json(f"{root}/versions")


def latest_version(spark: SparkSession, root: str) -> int:
    return versions(spark, root).agg(F.max("version")).first()[0]


def write_version(
    df: DataFrame, root: str, version: int, operation: str, at: dt.datetime
) -> None:
    """Write the data first and list the version last: a job that dies leaves no listed half."""
    df.write.mode("overwrite").parquet(_data(root, version))
    entry = df.sparkSession.createDataFrame([(version, at, operation)], _LIST_SCHEMA)
    entry.coalesce(1).write.mode("append").json(f"{root}/versions")


def read_version(spark: SparkSession, root: str, version: int) -> DataFrame:
    return spark.read.parquet(_data(root, version))


def read_as_of(spark: SparkSession, root: str, at: dt.datetime) -> DataFrame:
    """The newest version committed at or before ``at``."""
    listed = versions(spark, root).where(F.col("committed_at") <= F.lit(at).cast("timestamp_ntz"))
    version = listed.agg(F.max("version")).first()[0]
    if version is None:
        raise ValueError(f"no version at or before {at}")
    return read_version(spark, root, version)


def restore(spark: SparkSession, root: str, version: int, at: dt.datetime) -> int:
    """Go back by writing the old content as a new version; history stays."""
    new = latest_version(spark, root) + 1
    write_version(read_version(spark, root, version), root, new, f"restore {version}", at)
    return new


def expired_versions(
    spark: SparkSession, root: str, now: dt.datetime, keep: dt.timedelta
) -> DataFrame:
    """Dry run of retention: versions replaced before ``now - keep``; the newest is never listed."""
    from pyspark.sql import Window

    listed = versions(spark, root)
    replaced = F.lead("committed_at").over(Window.orderBy("version"))  # one row per version
    cutoff = F.lit(now - keep).cast("timestamp_ntz")
    return (
        listed.withColumn("replaced_at", replaced)
        .where(F.col("replaced_at") < cutoff)
        .select("version", "committed_at", "replaced_at")
    )
