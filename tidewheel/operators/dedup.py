"""Deduplication with a stated survivor."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Many frames as one, so that the result is written once."""
    return reduce(DataFrame.unionByName, frames)


def smallest_id(df: DataFrame, same: Sequence[str | Column], row_id: str) -> DataFrame:
    """The smallest id of each group of rows equal in ``same``. Combines before the shuffle."""
    return df.groupBy(*same).agg(F.min(row_id).alias(row_id))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def drop_copies(df: DataFrame, key: Column, row_id: str) -> DataFrame:
    """Keep the row with the smallest id of each group that shares ``key`` (a custom fuzzy key).

    Only (key, id) pairs are grouped, with a map-side minimum; the full rows come back by a
    join on the unique id, so that wide rows of a big group never meet in one task.
    """
    keep = df.groupBy(key.alias("_key")).agg(F.min(row_id).alias(row_id)).select(row_id)
    return df.join(keep, row_id, "left_semi")
