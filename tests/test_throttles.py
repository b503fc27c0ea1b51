"""The trailing throttle against a queue per user."""

from __future__ import annotations

import random
from collections import defaultdict, deque

import pytest
from pyspark.sql import functions as F

from tests.conftest import bag
from tidewheel.streaming.jobs import drained
from tidewheel.streaming.throttles import throttle_trailing, throttle_trailing_stream


def brute(rows, n, span):
    queues, out = defaultdict(deque), []
    for i, u, t in sorted((r for r in rows if r[1] is not None and r[2] is not None), key=lambda r: (r[2], r[0])):
        q = queues[u]
        while q and q[0] <= t - span:
            q.popleft()
        if len(q) < n:
            q.append(t)
            out.append((i, u, t))
    return sorted(out)


def sample(seed, n_rows, length):
    rnd = random.Random(seed)
    rows = [(i, 1 if i % 3 == 0 else rnd.randrange(2, 9), rnd.randrange(length)) for i in range(n_rows)]
    rows += [(n_rows, None, 5), (n_rows + 1, 4, None)]
    return rows


@pytest.mark.parametrize("hot_rows", [1_000_000, 40, 7])
@pytest.mark.parametrize("n, span", [(1, 50), (3, 20), (2, 1)])
def test_batch(spark, n, span, hot_rows):
    """Ties, gaps, a user with a third of all rows, and segments cut into many slices."""
    rows = sample(n, 260, 2500)
    df = spark.createDataFrame(rows, "row_id long, user long, at long")
    assert bag(throttle_trailing(df, "user", "at", "row_id", n, span, hot_rows)) == brute(rows, n, span)


def test_a_busy_user_is_carried_from_slice_to_slice(spark):
    rows = [(i, 1, i) for i in range(300)]
    got = bag(throttle_trailing(spark.createDataFrame(rows, "row_id long, user long, at long"), "user", "at", "row_id", 2, 7, 50))
    assert got == brute(rows, 2, 7)


def test_empty(spark):
    none = spark.createDataFrame([], "row_id long, user long, at long")
    assert throttle_trailing(none, "user", "at", "row_id", 2, 7).count() == 0


def test_stream_over_several_deliveries(spark, folder):
    """Times in tenths of a second, delivered in order of time in four files."""
    rows = [r for r in sample(4, 240, 4000) if r[1] is not None and r[2] is not None]
    micros = sorted(((i, u, t * 100_000) for i, u, t in rows), key=lambda r: (r[2], r[0]))
    for k in range(4):
        part = spark.createDataFrame(micros[60 * k : 60 * k + 60], "row_id long, user long, us long").coalesce(1)
        part.write.mode("append").parquet(f"{folder}/in")
    source = spark.readStream.schema("row_id long, user long, us long").option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    timed = source.withColumn("at_time", F.timestamp_micros("us")).withWatermark("at_time", "1 second")
    out = drained(throttle_trailing_stream(timed, "user", "at_time", "row_id", 2, 5_000_000), "throttled")
    assert bag(out, "row_id", "user", "at") == brute(micros, 2, 5_000_000)
    assert out.select("batch_id").distinct().count() >= 4
