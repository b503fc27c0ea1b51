"""Hot keys: find them, report them, spread them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_shares(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key and each key's share of all rows. Counts combine before the shuffle.

    The total is the sum of the counts, over the same exchange, so the input is read once.
    """
    counts = df.groupBy(*keys).agg(F.count("*").alias("n_rows"))
    total = counts.agg(F.sum("n_rows").alias("n")).scalar()
    return counts.withColumn("share", F.col("n_rows") / total)


def hot_keys(
    df: DataFrame, keys: Sequence[str], share: float = 0.001, min_rows: int = 1
) -> DataFrame:
    """Keys with at least ``share`` of all rows (and ``min_rows``): at most ``1 / share`` of them."""
    hot = (F.col("share") >= share) & (F.col("n_rows") >= min_rows)
    return key_shares(df, keys).where(hot).select(*keys)


def flag_hot(
    df: DataFrame,
    keys: Sequence[str],
    share: float = 0.001,
    min_rows: int = 1,
    flag: str = "is_hot",
) -> DataFrame:
    """``flag`` is true on rows of hot keys and NULL on others; a NULL key can be hot too.

    The broadcast side has at most ``1 / share`` rows, whatever the size of ``df``.
    """
    names = {k: f"_hot_{k}" for k in keys}
    hot = hot_keys(df, keys, share, min_rows).withColumnsRenamed(names).withColumn(flag, F.lit(True))
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(h)) for k, h in names.items()))
    return df.join(F.broadcast(hot), same, "left").drop(*names.values())


def salt_of(row_id: Sequence[str], n: int) -> Column:
    """Repeatable salt from columns that identify a row, so that a retried task gives the same."""
    return F.pmod(F.xxhash64(*row_id), F.lit(n)).cast("int")


def copies(n: int) -> Column:
    """All salts, one output row each."""
    return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))


def partition_rows(df: DataFrame) -> DataFrame:
    """Rows per physical partition."""
    return df.groupBy(F.spark_partition_id().alias("partition_id")).agg(
        F.count("*").alias("n_rows")
    )


def partition_count(df: DataFrame) -> DataFrame:
    """Number of partitions that hold rows."""
    return partition_rows(df).agg(F.count("*").alias("n_partitions"))
