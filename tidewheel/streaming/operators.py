"""Stream operators. Each works on a streaming or a batch DataFrame with columns (user, time, amount)."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def with_event_time(df: DataFrame, at: str, delay: str | None = None) -> DataFrame:
    """Event time as TIMESTAMP (a watermark refuses TIMESTAMP_NTZ), with a watermark if given."""
    typed = df.withColumn(at, F.col(at).cast("timestamp"))
    return typed.withWatermark(at, delay) if delay and df.isStreaming else typed


def keep(condition: Column) -> Callable[[DataFrame], DataFrame]:
    return lambda df: df.where(condition)


def derive(columns: dict[str, Column]) -> Callable[[DataFrame], DataFrame]:
    return lambda df: df.withColumns(columns)


def chain(df: DataFrame, steps: Sequence[Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Filter, map and window steps one after the other, for batch and stream alike."""
    for step in steps:
        df = df.transform(step)
    return df


def tumbling_counts(df: DataFrame, user: str, at: str, width: str) -> DataFrame:
    return (
        df.groupBy(F.window(at, width), user)
        .agg(F.count("*").alias("n_events"))
        .select(_start(), user, "n_events")
    )


def tumbling_sums(df: DataFrame, user: str, at: str, amount: str, width: str) -> DataFrame:
    return (
        df.groupBy(F.window(at, width), user)
        .agg(F.sum(amount).alias("amount"))
        .select(_start(), user, "amount")
    )


def _start() -> Column:
    return F.col("window.start").cast("timestamp_ntz").alias("window_start")


def session_sums(df: DataFrame, user: str, at: str, amount: str, gap: str) -> DataFrame:
    """One row per session: its start and the sum of its amounts; a gap of exactly ``gap`` stays in."""
    return (
        df.groupBy(F.session_window(at, gap), user)
        .agg(F.sum(amount).alias("amount"))
        .select(
            F.col("session_window.start").cast("timestamp_ntz").alias("session_start"),
            user,
            "amount",
        )
    )


def distinct_events(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One event per key; on a stream, within its watermark, so that state stays bounded."""
    if df.isStreaming:
        return df.dropDuplicatesWithinWatermark(list(keys))
    return df.dropDuplicates(list(keys))


def throttle(df: DataFrame, user: str, tick: str, order: Sequence[str], n: int) -> DataFrame:
    """First ``n`` events of each user in each whole tick (a second, say).

    With whole ticks the accepted events of the trailing tick are those of the same tick, so
    the rule is a rank within (user, tick). A busy user is spread over its ticks.
    """
    rank = F.row_number().over(Window.partitionBy(user, tick).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def throttle_stream(
    df: DataFrame, user: str, at: str, row_id: str, amount: str, n: int, groups: int = 256
) -> DataFrame:
    """Streaming :func:`throttle` by second, first by ``row_id`` within a micro-batch.

    (user, second) pairs are hashed into ``groups`` state groups, so that one call handles many
    pairs at once and a busy user is spread over groups by its seconds. A group's state counts
    accepted events per pair and forgets seconds the watermark has passed. Input needs a
    watermark on ``at``.
    """

    def take(
        key: tuple, batches: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        mark = state.getCurrentWatermarkMs() // 1000
        old = state.get if state.exists else ([], [], [])
        known = pd.DataFrame({"user_id": old[0], "second": old[1], "used": old[2]}, dtype="int64")
        if not state.hasTimedOut:
            rows = pd.concat(list(batches)).sort_values("row_id")
            rows = rows.merge(known, on=["user_id", "second"], how="left")
            place = rows.groupby(["user_id", "second"]).cumcount() + rows["used"].fillna(0)
            taken = rows[place < n]
            counts = taken.groupby(["user_id", "second"]).size().rename("used").reset_index()
            known = pd.concat([known, counts]).groupby(["user_id", "second"]).sum().reset_index()
            yield taken[["row_id", "user_id", "second", "amount"]]
        known = known[known["second"] >= mark]
        if known.empty:
            state.remove()
        else:
            state.update(tuple(known[c].tolist() for c in ("user_id", "second", "used")))
            state.setTimeoutTimestamp((max(mark, int(known["second"].max())) + 1) * 1000)

    shaped = df.select(
        F.col(row_id).cast("bigint").alias("row_id"),
        F.col(user).cast("bigint").alias("user_id"),
        F.col(at).cast("bigint").alias("second"),
        F.col(amount).cast("double").alias("amount"),
        F.col(at).alias("at"),
        F.pmod(F.xxhash64(F.col(user), F.col(at)), F.lit(groups)).alias("state_group"),
    )
    return shaped.groupBy("state_group").applyInPandasWithState(
        take,
        "row_id BIGINT, user_id BIGINT, second BIGINT, amount DOUBLE",
        "users ARRAY<BIGINT>, seconds ARRAY<BIGINT>, used ARRAY<BIGINT>",
        "append",
        GroupStateTimeout.EventTimeTimeout,
    )


def lateness(df: DataFrame, at: str, arrived: str, tolerance: int) -> DataFrame:
    """Rows on time and late: more than ``tolerance`` seconds behind the newest event before them
    in arrival batches. ``arrived`` numbers the batches; the newest event time per earlier batch
    is one row per batch."""
    per_batch = df.groupBy(arrived).agg(F.max(at).alias("_top"))
    before = Window.orderBy(arrived).rowsBetween(Window.unboundedPreceding, -1)
    marks = per_batch.select(arrived, F.max("_top").over(before).alias("_newest"))
    late = F.coalesce(F.col(at) < F.col("_newest") - F.make_interval(secs=F.lit(tolerance)), F.lit(False))
    return df.join(marks, arrived).withColumn("is_late", late).drop("_newest")
