"""Joins beyond the built-in ones: size-checked, salted, split and guarded."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.operators.skew import copies, flag_hot, hot_keys, salt_of
from tidewheel.sources.sinks import BROADCAST_LIMIT, broadcast_hint


def small_side_join(
    fact: DataFrame,
    dim: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Broadcast ``dim`` if its measured size is within ``limit``; else a shuffle join.

    The shuffle join is left to adaptive execution, which splits skewed partitions.
    """
    keys = [on] if isinstance(on, str) else list(on)
    return fact.join(broadcast_hint(dim, limit)(dim), keys, how)


def salted_join(
    fact: DataFrame, dim: DataFrame, keys: Sequence[str], row_id: Sequence[str], n: int = 16
) -> DataFrame:
    """Inner join with every key spread over ``n`` salts; ``dim`` is copied ``n`` times.

    Always by shuffle: Spark takes the copies to be as small as ``dim``, and would broadcast all of them.
    """
    left = fact.withColumn("_salt", salt_of(row_id, n))
    right = dim.withColumn("_salt", copies(n)).hint("merge")
    return left.join(right, [*keys, "_salt"]).drop("_salt")


def hot_salted_join(
    fact: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    row_id: Sequence[str],
    n: int = 16,
    share: float = 0.001,
) -> DataFrame:
    """Inner join that salts hot keys only, so that just their dimension rows are copied.

    Which keys are hot is measured on ``fact``; all others keep salt 0.
    """
    hot = hot_keys(fact, keys, share).withColumn("_hot", F.lit(True))
    left = (
        fact.join(F.broadcast(hot), list(keys), "left")
        .withColumn("_salt", F.when(F.col("_hot"), salt_of(row_id, n)).otherwise(0))
        .drop("_hot")
    )
    every = F.sequence(F.lit(0), F.lit(n - 1))
    right = (
        dim.join(F.broadcast(hot), list(keys), "left")
        .withColumn("_salt", F.explode(F.when(F.col("_hot"), every).otherwise(F.array(F.lit(0)))))
        .drop("_hot")
    )
    return left.join(right, [*keys, "_salt"]).drop("_salt")


def hot_split_join(
    fact: DataFrame, dim: DataFrame, keys: Sequence[str], share: float = 0.001
) -> DataFrame:
    """Inner join to a dimension with unique keys: hot rows by broadcast, the rest by shuffle.

    At most ``1 / share`` dimension rows are broadcast, whatever the size of the tables.
    """
    flagged = flag_hot(fact, keys, share, flag="_hot")
    hot_dim = dim.join(F.broadcast(hot_keys(fact, keys, share)), list(keys), "left_semi")
    hot = flagged.where("_hot").drop("_hot").join(F.broadcast(hot_dim), list(keys))
    rest = flagged.where("_hot IS NULL").drop("_hot").join(dim, list(keys))
    return hot.unionByName(rest)


def either_key_join(
    left: DataFrame, right: DataFrame, pairs: Sequence[tuple[Column, Column]]
) -> DataFrame:
    """``a = b OR c = d`` as one equi-join per pair; a later branch leaves out earlier matches.

    Column names of the two sides must differ.
    """
    branches, earlier = [], F.lit(False)
    for lcol, rcol in pairs:
        branches.append(left.join(right, (lcol == rcol) & ~earlier))
        earlier = earlier | F.coalesce(lcol == rcol, F.lit(False))
    return reduce(DataFrame.unionByName, branches)


def one_row_per_key_join(
    fact: DataFrame, many: DataFrame, keys: Sequence[str], measures: dict[str, Column], how: str = "left"
) -> DataFrame:
    """Bring ``many`` to one row per key first, so that the join cannot repeat fact rows."""
    single = many.groupBy(*keys).agg(*[expr.alias(name) for name, expr in measures.items()])
    return fact.join(single, list(keys), how)


def left_join_flagged(
    left: DataFrame, right: DataFrame, keys: Sequence[str], flag: str = "matched"
) -> DataFrame:
    """Left join that keeps every row and says whether it matched.

    Rows with a NULL key match nothing: they skip the join (and its shuffle, where they would
    all meet in one task) and come back through the union.
    """
    has_key = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys))
    marked = right.withColumn(flag, F.lit(True))
    joined = left.where(has_key).join(marked, list(keys), "left")
    return joined.unionByName(left.where(~has_key), allowMissingColumns=True).withColumn(
        flag, F.coalesce(F.col(flag), F.lit(False))
    )


def needed_join(left: DataFrame, keys_of: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join to a table of which only the keys are read, left out where it changes nothing.

    It changes nothing if no key occurs twice in ``keys_of`` and every row of ``left`` finds one. Both are
    checked on keys alone, before wide rows move; otherwise the join is made.
    """
    repeated = keys_of.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1")
    if repeated.isEmpty() and without_match(left.select(*keys).distinct(), keys_of, keys).isEmpty():
        return left
    return left.join(keys_of, list(keys))


def without_match(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` with no partner; NULL keys count as no partner and skip the shuffle."""
    has_key = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys))
    lone = left.where(has_key).join(right.select(*keys), list(keys), "left_anti")
    return lone.unionByName(left.where(~has_key))


def co_partitioned_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], n: int
) -> DataFrame:
    """Both sides hashed into the same ``n`` partitions; work after it on ``keys`` needs no shuffle."""
    return left.repartition(n, *keys).join(right.repartition(n, *keys), list(keys))
