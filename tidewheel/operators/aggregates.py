"""Aggregations that stay spread when one key dominates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.functions.times import time_slice
from tidewheel.operators.skew import flag_hot, salt_of
from tidewheel.operators.windows import HOT_ROWS, HOT_SHARE, running_sums
from tidewheel.sources.sinks import materialised


def salted_totals(
    df: DataFrame, keys: Sequence[str], value: str, row_id: Sequence[str], n: int = 16
) -> DataFrame:
    """Sum, count and average in two stages: by (key, salt), then by key."""
    partial = df.groupBy(*keys, salt_of(row_id, n).alias("_salt")).agg(
        F.sum(value).alias("_sum"), F.count(value).alias("_n")
    )
    return partial.groupBy(*keys).agg(
        F.sum("_sum").alias("total"),
        F.sum("_n").alias("n_values"),
        (F.sum("_sum") / F.sum("_n")).alias("mean"),
    )


def percent_of_total(per_key: DataFrame, value: str, name: str = "pct_of_total") -> DataFrame:
    """Share of the grand total; the total is a scalar subquery, not an unpartitioned window."""
    total = per_key.agg(F.sum(value).alias("t")).scalar()
    return per_key.withColumn(name, 100.0 * F.col(value) / total)


def pivot_sum(
    df: DataFrame, keys: Sequence[str], column: str, values: Sequence[str], measure: Column
) -> DataFrame:
    """One output column per listed value, so that no extra job looks for the values."""
    return df.groupBy(*keys).pivot(column, list(values)).agg(measure)


def exact_median(
    df: DataFrame, keys: Sequence[str], value: str, width: float, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Exact median per key without holding a key's values in one task.

    Equal values are counted first. Running counts from both ends give each value its positions
    and the size of its key; the one or two middle positions are averaged. Keys with very many
    distinct values are cut into value slices of ``width``.
    """
    cut = time_slice(F.col(value), width)
    n = {"_upto": F.col("_n")}, {"_down": F.col("_n")}
    # Read several times below, and far smaller than the rows: computed once.
    every = materialised(df.groupBy(*keys, value).agg(F.count("*").alias("_n")), "median")
    counted = flag_hot(every.where(F.col(value).isNotNull()), keys, HOT_SHARE, hot_rows, "_hot")
    placed = running_sums(counted, keys, [value], cut, n[0])
    placed = running_sums(placed, keys, [value], cut, n[1], backwards=True)
    size = F.col("_upto") + F.col("_down") - F.col("_n")
    low, high = F.floor((size + 1) / 2), F.floor((size + 2) / 2)
    middle = placed.where((low <= F.col("_upto")) & (high > F.col("_upto") - F.col("_n")))
    found = middle.groupBy(*keys).agg(((F.min(value) + F.max(value)) / 2).alias("median"))
    # a key with NULLs only has no value to order, and a median of NULL
    bare = every.groupBy(*keys).agg(F.count(value).alias("_n")).where("_n = 0")
    return found.unionByName(bare.select(*keys, F.lit(None).cast(found.schema["median"].dataType).alias("median")))


def counts_where(conditions: dict[str, Column]) -> list[Column]:
    """One conditional count per entry, for a single pass."""
    return [F.count_if(cond).alias(name) for name, cond in conditions.items()]
