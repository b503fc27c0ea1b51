"""Incremental loads: marks, bronze/silver/gold steps and rolling spend of new rows only."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.functions.text import clean
from tidewheel.functions.times import epoch_seconds, time_slice
from tidewheel.operators.windows import HOT_ROWS, latest, rolling_sums

_MARKS = "source STRING, mark TIMESTAMP_NTZ"


def read_mark(spark: SparkSession, path: str, source: str) -> dt.datetime | None:
    """Highest mark stored for ``source``; None before the first load."""
    marks = spark.read.schema(_MARKS).json(path)
    return marks.where(F.col("source") == source).agg(F.max("mark")).first()[0]


def save_mark(spark: SparkSession, path: str, source: str, mark: dt.datetime | None) -> None:
    """Append a mark row. An empty load has no mark and stores nothing."""
    if mark is not None:
        row = spark.createDataFrame([(source, mark)], _MARKS)
        row.coalesce(1).write.mode("append").json(path)


def since(df: DataFrame, at: str, mark: dt.datetime | None) -> DataFrame:
    """Rows from the mark on. The mark itself is read again, so that late ties are not lost;
    the merge that follows is keyed and makes the repeat harmless. No mark means all rows."""
    return df if mark is None else df.where(F.col(at) >= F.lit(mark).cast("timestamp_ntz"))


def next_mark(loaded: DataFrame, at: str) -> dt.datetime | None:
    return loaded.agg(F.max(at)).first()[0]


def to_silver(raw: DataFrame, statuses: Sequence[str]) -> DataFrame:
    """Typed, clean, deduplicated rows from text columns (row_id, user_id, amount, status, ts)."""
    typed = raw.select(
        F.col("row_id").try_cast("bigint").alias("row_id"),
        F.col("user_id").try_cast("bigint").alias("user_id"),
        F.col("amount").try_cast("double").alias("amount"),
        clean("status").alias("status"),
        F.col("ts").try_cast("timestamp_ntz").alias("ts"),
    )
    good = typed.where(
        F.col("row_id").isNotNull() & (F.col("amount") > 0) & F.col("status").isin(list(statuses))
    )
    return latest(good, ["row_id"], "ts", "amount")


def to_gold(silver: DataFrame) -> DataFrame:
    """Daily revenue, order count and average by status."""
    return silver.groupBy(F.to_date("ts").alias("day"), "status").agg(
        F.round(F.sum("amount"), 2).alias("revenue"),
        F.count("*").alias("n_orders"),
        F.round(F.avg("amount"), 4).alias("avg_amount"),
    )


def spend_of_new(
    events: DataFrame,
    user: str,
    at: str,
    amount: str,
    mark: dt.datetime | None,
    reach: int = 86_400,
    slice_width: int = 3_600,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Rolling spend (``spend``) for rows after ``mark``.

    Reads back ``reach`` seconds before the mark, so that the sums are whole, and gives only
    the new rows.
    """
    wanted = events
    if mark is not None:
        floor = mark - dt.timedelta(seconds=reach + 1)
        wanted = events.where(F.col(at) >= F.lit(floor).cast("timestamp_ntz"))
    rolled = rolling_sums(
        wanted.withColumn("_sec", epoch_seconds(at)),
        [user],
        "_sec",
        time_slice("_sec", slice_width),
        amount,
        reach,
        prefix="_spend",
        hot_rows=hot_rows,
    ).withColumn("spend", F.round("_spend_sum", 2))
    if mark is not None:
        rolled = rolled.where(F.col(at) > F.lit(mark).cast("timestamp_ntz"))
    return rolled.drop("_sec", "_spend_sum", "_spend_n")
