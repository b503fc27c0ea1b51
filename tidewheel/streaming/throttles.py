"""At most ``n`` accepted events of a user in any trailing span, in order of time.

An event is accepted if fewer than ``n`` accepted events of its user are younger than ``span`` at its
time. Whether it is depends on the events accepted before it, so the rule is no rank or window count.

Batch: an event at least ``span`` after its predecessor finds nothing left of the past, so a user's
events fall into independent segments. Segments of at most ``n`` events are accepted as a whole by plain
DataFrame work. The others are sorted by time and read as a stream, with the last accepted times carried
from batch to batch. A segment with more than ``hot_rows`` events is cut into slices of so many; slice
k of all such segments is worked on together, with the times accepted in slice k - 1 carried over, so that
no task ever holds more than a slice of a user.

Stream: the accepted times of the trailing span are the state.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidewheel.operators.windows import HOT_ROWS, running_sums, runs
from tidewheel.sources.sinks import materialised


def accept(times: np.ndarray, carried: list[int], n: int, span: int) -> tuple[np.ndarray, list[int]]:
    """Places of accepted events among sorted ``times``, and the last ``n`` accepted times.

    ``carried`` are the last accepted times before. The next accepted event is the first one that is
    ``span`` past the n-th last accepted time, so the work grows with what is accepted, not with what is
    refused.
    """
    taken, last, at = [], list(carried)[-n:], 0
    while at < len(times):
        if len(last) == n:
            at = max(at, int(np.searchsorted(times, last[0] + span)))
            if at == len(times):
                break
        taken.append(at)
        last = [*last, int(times[at])][-n:]
        at += 1
    return np.array(taken, np.int64), last


def throttle_trailing(
    df: DataFrame, user: str, at: str, row_id: str, n: int, span: int, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Accepted rows as (``row_id``, ``user``, ``at``); ``at`` is a whole number, ``span`` of its unit.

    Events of one time are taken by ``row_id``, which must be unique. Events without a user or a time
    are not accepted.
    """
    rows = df.select(F.col(user).alias("_u"), F.col(at).cast("long").alias("_t"), F.col(row_id).alias("_id"))
    rows = rows.where("_u IS NOT NULL AND _t IS NOT NULL")
    opens = F.col("_prev").isNull() | (F.col("_t") - F.col("_prev") >= span)
    by_time = F.floor(F.col("_t") / span)
    parts = materialised(runs(rows, ["_u"], ["_t", "_id"], by_time, F.col("_t"), opens, "_s", hot_rows), "segments")
    sizes = parts.groupBy("_u", "_s").agg(F.count("*").alias("_k"))
    sized = materialised(parts.join(sizes, ["_u", "_s"]), "sized-segments")

    names = [F.col("_id").alias(row_id), F.col("_u").alias(user), F.col("_t").alias(at)]
    free = sized.where(F.col("_k") <= n).select("_id", "_u", "_t")
    busy = sized.where((F.col("_k") > n) & (F.col("_k") <= hot_rows)).select("_u", "_s", "_t", "_id")
    out = [free, _streamed(busy, n, span), *_sliced(sized.where(F.col("_k") > hot_rows), n, span, hot_rows)]
    return reduce(DataFrame.unionByName, out).select(*names)


def _streamed(rows: DataFrame, n: int, span: int) -> DataFrame:
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: tuple | None = None
        last: list[int] = []
        for batch in batches:
            kept = []
            for key, part in batch.groupby(["_u", "_s"], sort=False):
                taken, last = accept(part["_t"].to_numpy(), last if key == known else [], n, span)
                known = key
                kept.append(part.iloc[taken])
            if kept:
                yield pd.concat(kept)[["_id", "_u", "_t"]]

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    dealt = rows.repartition("_u", "_s").sortWithinPartitions("_u", "_s", "_t", "_id")
    return dealt.mapInPandas(work, f"_id {kinds['_id']}, _u {kinds['_u']}, _t bigint")


def _sliced(rows: DataFrame, n: int, span: int, hot_rows: int) -> list[DataFrame]:
    """Accepted rows of very long segments, one frame per slice."""
    if rows.isEmpty():
        return []
    placed = running_sums(rows, ["_u", "_s"], ["_t", "_id"], F.floor(F.col("_t") / span), {"_p": F.lit(1)}, hot_rows=hot_rows)
    placed = materialised(placed.withColumn("_slice", F.floor((F.col("_p") - 1) / hot_rows)), "throttle-slices")
    kinds = {f.name: f.dataType.simpleString() for f in placed.schema.fields}
    schema = f"_id {kinds['_id']}, _u {kinds['_u']}, _s bigint, _t bigint, _last array<bigint>"
    key = ["_u", "_s"]

    def work(part: pd.DataFrame, state: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["_t", "_id"])
        before = [int(x) for x in state["_last"].iloc[0]] if len(state) else []
        taken, last = accept(part["_t"].to_numpy(), before, n, span)
        out = part.iloc[taken][["_id", "_u", "_s", "_t"]].assign(_last=None)
        end = part.iloc[:1][["_u", "_s"]].assign(_id=None, _t=None, _last=[last])
        return pd.concat([out, end])[["_id", "_u", "_s", "_t", "_last"]].astype({"_id": "object", "_t": "object"})

    last = placed.agg(F.max("_slice")).first()[0]
    state = rows.sparkSession.createDataFrame([], f"_u {kinds['_u']}, _s bigint, _last array<bigint>")
    found = []
    for k in range(last + 1):
        piece = placed.where(F.col("_slice") == k).select("_u", F.col("_s").cast("bigint").alias("_s"), "_t", "_id")
        done = piece.groupBy(*key).cogroup(state.groupBy(*key)).applyInPandas(work, schema)
        done = materialised(done, "throttled-slice")
        found.append(done.where("_last IS NULL").select("_id", "_u", "_t"))
        state = done.where("_last IS NOT NULL").select("_u", "_s", "_last")
    return found


def throttle_trailing_stream(
    df: DataFrame, user: str, at: str, row_id: str, n: int, span: int, groups: int = 256
) -> DataFrame:
    """Streaming :func:`throttle_trailing` over an event-time column with a watermark; ``span`` in microseconds.

    Micro-batches are taken in turn, the events of one by time and ``row_id``. Users are hashed into ``groups``
    state groups. A group's state holds the accepted times younger than ``span`` before the watermark; an
    event behind an accepted one counts it as of the same time.
    """

    def take(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        mark = state.getCurrentWatermarkMs() * 1000
        held: dict[int, list[int]] = {}
        if state.exists:
            for u, t in zip(*state.get, strict=True):
                held.setdefault(u, []).append(t)
        if not state.hasTimedOut:
            rows = pd.concat(list(batches)).sort_values(["at", "row_id"])
            for u, part in rows.groupby("user_id", sort=False):
                before = held.get(int(u), [])
                taken, held[int(u)] = accept(np.maximum(part["at"].to_numpy(), before[-1] if before else -(1 << 62)), before, n, span)
                yield part.iloc[taken][["row_id", "user_id", "at"]]
        left = [(u, t) for u, times in held.items() for t in times if t > mark - span]
        if left:
            state.update(([u for u, _ in left], [t for _, t in left]))
            state.setTimeoutTimestamp((max(max(t for _, t in left) + span, mark) // 1000) + 1)
        elif state.exists:
            state.remove()

    shaped = df.select(
        F.col(row_id).cast("bigint").alias("row_id"),
        F.col(user).cast("bigint").alias("user_id"),
        F.unix_micros(at).alias("at"),
        F.col(at).alias("clock"),
        F.pmod(F.xxhash64(user), F.lit(groups)).alias("state_group"),
    ).where("user_id IS NOT NULL AND at IS NOT NULL")
    out = shaped.groupBy("state_group").applyInPandasWithState(
        take, "row_id BIGINT, user_id BIGINT, at BIGINT", "users ARRAY<BIGINT>, times ARRAY<BIGINT>", "append",
        GroupStateTimeout.EventTimeTimeout,
    )
    return out.select(F.col("row_id").alias(row_id), F.col("user_id").alias(user), "at")
