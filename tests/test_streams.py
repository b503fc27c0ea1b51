"""Streams over several files must end where the batch form ends."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import bag
from tidewheel.operators.enrich import call_with_retry, enriched
from tidewheel.sources.readers import new_files, table_stream
from tidewheel.streaming import operators as so
from tidewheel.streaming.jobs import (
    drain,
    drained,
    ingest_files,
    merge_into_versions,
    newest_state,
    to_batch_folders,
)

SCHEMA = "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, amount DOUBLE"
T0 = dt.datetime(2024, 1, 1)


def second(s):
    return T0 + dt.timedelta(seconds=s)


@pytest.fixture(scope="module")
def events(spark):
    rnd = random.Random(3)
    times = sorted(rnd.randrange(0, 2000) for _ in range(120))
    return [(i, second(t), rnd.randrange(3), rnd.randrange(1, 40) / 4) for i, t in enumerate(times)]


def deliver(spark, folder, *deliveries):
    """One file per delivery, in this order."""
    for rows in deliveries:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def stream(spark, folder, delay="60 seconds"):
    df = new_files(spark, folder, SCHEMA, maxFilesPerTrigger=1)
    return so.with_event_time(df, "ts", delay)


@pytest.fixture
def inbox(spark, folder, events):
    path = f"{folder}/in"
    deliver(spark, path, events[:40], events[40:80], events[80:])
    return path


def batch(spark, events):
    return so.with_event_time(spark.createDataFrame(events, SCHEMA), "ts")


def test_windows_in_stream_and_batch(spark, inbox, events):
    live, still = stream(spark, inbox), batch(spark, events)
    keys = ["window_start", "user_id"]
    counted = so.tumbling_counts(live, "user_id", "ts", "60 seconds")
    want = bag(so.tumbling_counts(still, "user_id", "ts", "60 seconds"))
    assert bag(newest_state(drained(counted, "c", "update"), keys)) == want
    summed = so.tumbling_sums(live, "user_id", "ts", "amount", "60 seconds")
    want = bag(so.tumbling_sums(still, "user_id", "ts", "amount", "60 seconds"))
    assert bag(newest_state(drained(summed, "s", "update"), keys)) == want


def test_closed_windows_only_in_append_mode(spark, inbox, events):
    summed = so.tumbling_sums(stream(spark, inbox), "user_id", "ts", "amount", "60 seconds")
    have = set(bag(drained(summed, "a").drop("batch_id")))
    want = set(bag(so.tumbling_sums(batch(spark, events), "user_id", "ts", "amount", "60 seconds")))
    assert have < want


def test_sessions_and_exact_gap(spark, folder):
    rows = [(0, second(0), 1, 1.0), (1, second(30), 1, 1.0), (2, second(61), 1, 1.0)]
    deliver(spark, f"{folder}/s", rows[:2], rows[2:])
    want = [(second(0), 1, 2.0), (second(61), 1, 1.0)]
    assert bag(so.session_sums(batch(spark, rows), "user_id", "ts", "amount", "30 seconds")) == want
    out = drained(so.session_sums(stream(spark, f"{folder}/s"), "user_id", "ts", "amount", "30 seconds"), "w", "complete")
    last = out.agg(F.max("batch_id")).first()[0]
    assert bag(out.where(F.col("batch_id") == last).drop("batch_id")) == want


def test_tumbling_boundaries(spark):
    rows = [(0, second(0), 1, 1.0), (1, second(59), 1, 2.0), (2, second(60), 1, 4.0)]
    out = so.tumbling_sums(batch(spark, rows), "user_id", "ts", "amount", "60 seconds")
    assert bag(out) == [(second(0), 1, 3.0), (second(60), 1, 4.0)]


def test_late_rows_are_dropped(spark, folder):
    deliver(
        spark,
        f"{folder}/l",
        [(0, second(0), 1, 1.0), (1, second(1000), 1, 1.0)],
        [(2, second(2000), 1, 1.0)],
        [(3, second(10), 1, 5.0), (4, second(5000), 1, 1.0)],  # the first is far too late
    )
    out = drained(so.tumbling_sums(stream(spark, f"{folder}/l"), "user_id", "ts", "amount", "60 seconds"), "late")
    assert (second(0), 1, 1.0) in bag(out.drop("batch_id"))
    assert out.agg(F.max("amount")).first()[0] == 1.0


def test_throttle(spark, folder):
    rows = [(0, second(0), 1, 1.0), (1, second(0), 1, 1.0), (2, second(0), 1, 1.0), (3, second(1), 1, 1.0), (4, second(0), 2, 1.0)]
    ticks = spark.createDataFrame(rows, SCHEMA).withColumn("tick", F.col("ts").cast("bigint"))
    want = [(0,), (1,), (3,), (4,)]
    assert bag(so.throttle(ticks, "user_id", "tick", ["event_id"], 2), "event_id") == want
    # Two accepted in the first file, the third of that second arrives in the next one.
    deliver(spark, f"{folder}/t", [rows[0], rows[1], rows[4]], [rows[2], rows[3]])
    for groups in (1, 7):
        live = so.throttle_stream(stream(spark, f"{folder}/t"), "user_id", "ts", "event_id", "amount", 2, groups)
        assert bag(drained(live, "throttle"), "row_id") == want


def test_chain_of_steps(spark, inbox, events):
    steps = [
        so.keep(F.col("amount") > 2),
        so.derive({"amount": F.col("amount") * 2}),
        lambda df: so.tumbling_sums(df, "user_id", "ts", "amount", "300 seconds"),
    ]
    want = bag(so.chain(batch(spark, events), steps))
    out = newest_state(drained(so.chain(stream(spark, inbox), steps), "chain", "update"), ["window_start", "user_id"])
    assert bag(out) == want


def test_stream_dedup(spark, folder, events):
    deliver(spark, f"{folder}/d", events[:60], events[30:90], events[90:])
    once = so.distinct_events(stream(spark, f"{folder}/d", "1 hour"), ["event_id"])
    assert bag(drained(once, "dedup"), "event_id") == [(e[0],) for e in events]
    assert so.distinct_events(batch(spark, events + events), ["event_id"]).count() == len(events)


def test_restart_reads_nothing_twice(spark, folder, events):
    path, sink = f"{folder}/r", to_batch_folders(f"{folder}/out")
    deliver(spark, path, events[:50])
    drain(stream(spark, path), sink, f"{folder}/cp")
    drain(stream(spark, path), sink, f"{folder}/cp")
    deliver(spark, path, events[50:])
    drain(stream(spark, path), sink, f"{folder}/cp")
    assert bag(spark.read.parquet(f"{folder}/out"), "event_id") == [(e[0],) for e in events]


def test_only_new_files_are_ingested(spark, folder, events):
    for part in (events[:50], events[50:]):
        deliver(spark, f"{folder}/in", part)
        ingest_files(spark, new_files(spark, f"{folder}/in", SCHEMA), f"{folder}/landed", f"{folder}/cp")
    assert bag(spark.read.parquet(f"{folder}/landed"), "event_id") == [(e[0],) for e in events]


def test_micro_batch_merge(spark, inbox, folder, events):
    merge = merge_into_versions(f"{folder}/table", ["user_id"], ("ts", "event_id"))
    drain(stream(spark, inbox), merge, f"{folder}/cp")
    newest = {}
    for e in events:
        newest[e[2]] = max(newest.get(e[2], e), e, key=lambda r: (r[1], r[0]))
    assert dict(bag(spark.read.parquet(f"{folder}/table/v=2"), "user_id", "event_id")) == {u: e[0] for u, e in newest.items()}
    # A batch that runs again gives the same version.
    merge(spark.createDataFrame(events[80:], SCHEMA), 2)
    assert spark.read.parquet(f"{folder}/table/v=2").count() == len(newest)


def test_a_table_may_be_one_file_or_a_folder(spark, folder, events):
    deliver(spark, f"{folder}/events.parquet", events)
    assert drained(table_stream(spark, folder, "events", SCHEMA), "t").count() == len(events)


def test_lateness(spark):
    rows = [(1, second(100), 0), (2, second(900), 1), (3, second(50), 1), (4, second(700), 2), (5, second(200), 2)]
    df = spark.createDataFrame(rows, "id INT, ts TIMESTAMP_NTZ, arrived INT")
    out = so.lateness(df, "ts", "arrived", 300)
    assert bag(out, "id", "is_late") == [(1, False), (2, False), (3, False), (4, False), (5, True)]


def test_retry_policy():
    waits, calls = [], []

    def flaky(key):
        calls.append(key)
        if len(calls) < 3:
            raise RuntimeError("nope")
        return "ok"

    assert call_with_retry(flaky, 1, attempts=4, base=1, cap=1.5, jitter=0, sleep=waits.append) == ("ok", 3, None)
    assert waits == [1, 1.5]

    def broken(key):
        raise ConnectionError("busy")

    assert call_with_retry(broken, 1, attempts=2, base=0, jitter=0, sleep=waits.append) == (None, 2, "ConnectionError: busy")
    with pytest.raises(ValueError):
        call_with_retry(lambda k: int("x"), 1, retry_on=(ConnectionError,), sleep=waits.append)


def test_enrichment_gives_every_row(spark):
    def client():
        seen = {}

        def call(key):
            seen[key] = seen.get(key, 0) + 1
            if seen[key] <= key % 4:
                raise ConnectionError("busy")
            return f"user_{key}"

        return call

    out = enriched(spark.range(8).repartition(3), "id", client, attempts=3, base=0.0, jitter=0.0)
    assert bag(out, "id", "result", "attempts") == [
        (i, f"user_{i}" if i % 4 < 3 else None, min(i % 4 + 1, 3)) for i in range(8)
    ]
