"""Ordered operators against brute force: plain, partly sliced and fully sliced give the same."""

from __future__ import annotations

import random
import statistics
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import bag
from tidewheel.functions.times import time_slice
from tidewheel.operators.aggregates import exact_median
from tidewheel.operators.history import version_at
from tidewheel.operators.windows import (
    carried,
    latest,
    moving_average,
    neighbour,
    ranks,
    rolling_sums,
    rolling_totals,
    running_sums,
    session_totals,
    sessions,
    top_n,
)

LIMITS = [1, 40, 1_000_000]  # every key sliced, only the busy ones, none


def cut():
    return time_slice("at", 10)


def make_rows(seed=5, n=200):
    """(id, k, at, v): key 'a' has half of all rows; some keys and values are NULL."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        k = rnd.choice(["a", "a", "a", "b", "c", None])
        rows.append((i, k, rnd.randrange(0, 120), None if rnd.random() < 0.15 else rnd.randrange(1, 50) / 4))
    return rows


@pytest.fixture(scope="module")
def rows():
    return make_rows()


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "id INT, k STRING, at BIGINT, v DOUBLE").repartition(4)


def by_key(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    return {k: sorted(g, key=lambda r: (r[2], r[0])) for k, g in groups.items()}


def total(values):
    kept = [v for v in values if v is not None]
    return sum(kept) if kept else None


@pytest.mark.parametrize("hot_rows", LIMITS)
def test_running_sums(df, rows, hot_rows):
    want = {r[0]: total([x[3] for x in g[: i + 1]]) for g in by_key(rows).values() for i, r in enumerate(g)}
    out = running_sums(df, ["k"], ["at", "id"], cut(), {"s": F.col("v")}, hot_rows=hot_rows)
    assert out.columns == ["id", "k", "at", "v", "s"]
    assert dict(bag(out, "id", "s")) == want


@pytest.mark.parametrize("hot_rows", LIMITS)
def test_running_sums_backwards(df, rows, hot_rows):
    want = {r[0]: total([x[3] for x in g[i:]]) for g in by_key(rows).values() for i, r in enumerate(g)}
    out = running_sums(df, ["k"], ["at", "id"], cut(), {"s": F.col("v")}, backwards=True, hot_rows=hot_rows)
    assert dict(bag(out, "id", "s")) == want


@pytest.mark.parametrize("hot_rows", LIMITS)
def test_neighbours(df, rows, hot_rows):
    before, after = {}, {}
    for g in by_key(rows).values():
        for i, r in enumerate(g):
            before[r[0]] = g[i - 1][3] if i else None
            after[r[0]] = g[i + 1][3] if i + 1 < len(g) else None
    order = ["at", "id"]
    lag = neighbour(df, ["k"], order, cut(), {"x": F.col("v")}, hot_rows=hot_rows)
    lead = neighbour(df, ["k"], order, cut(), {"x": F.col("v")}, following=True, hot_rows=hot_rows)
    assert dict(bag(lag, "id", "x")) == before
    assert dict(bag(lead, "id", "x")) == after


@pytest.mark.parametrize("hot_rows", LIMITS)
def test_carried(df, rows, hot_rows):
    want = {}
    for g in by_key(rows).values():
        last = None
        for r in g:
            last = r[3] if r[3] is not None else last
            want[r[0]] = last
    out = carried(df, ["k"], ["at", "id"], cut(), {"x": F.col("v")}, hot_rows=hot_rows)
    assert dict(bag(out, "id", "x")) == want


@pytest.mark.parametrize("hot_rows", LIMITS)
@pytest.mark.parametrize("reach", [0, 7, 35])
def test_rolling_sums(df, rows, hot_rows, reach):
    want = {}
    for g in by_key(rows).values():
        for r in g:
            frame = [x[3] for x in g if r[2] - reach <= x[2] <= r[2]]
            want[r[0]] = (total(frame), sum(v is not None for v in frame))
    out = rolling_sums(df, ["k"], "at", cut(), "v", reach, "w", hot_rows)
    assert {i: (s, n) for i, s, n in bag(out, "id", "w_sum", "w_n")} == want


@pytest.mark.parametrize("hot_rows", LIMITS)
def test_rolling_totals(df, rows, hot_rows):
    want = {}
    for k, g in by_key(rows).items():
        for r in g:
            want[(k, r[2])] = total([x[3] for x in g if r[2] - 9 <= x[2] <= r[2]])
    out = rolling_totals(df, ["k"], "at", cut(), "v", 9, "w", hot_rows)
    assert {(k, a): s for k, a, s in bag(out, "k", "at", "w_sum")} == want


@pytest.mark.parametrize("hot_rows", [2, 40, 1_000_000])
def test_moving_average(df, rows, hot_rows):
    want = {}
    for g in by_key(rows).values():
        for i, r in enumerate(g):
            frame = [x[3] for x in g[max(0, i - 6) : i + 1] if x[3] is not None]
            want[r[0]] = sum(frame) / len(frame) if frame else None
    out = moving_average(df, ["k"], ["at", "id"], cut(), "v", 7, "m", hot_rows)
    assert dict(bag(out, "id", "m")) == want


@pytest.mark.parametrize("hot_rows", LIMITS)
def test_sessions(df, rows, hot_rows):
    want, totals = {}, []
    for k, g in by_key(rows).items():
        number, last = 0, None
        for r in g:
            if last is None or r[2] - last > 3:
                number += 1
                totals.append([k, r[2], []])
            totals[-1][2].append(r[3])
            last, want[r[0]] = r[2], number
    out = sessions(df, ["k"], "at", "id", cut(), 3, hot_rows=hot_rows)
    assert dict(bag(out, "id", "session_id")) == want
    sums = session_totals(df, ["k"], "at", "id", cut(), 3, "v", hot_rows)
    have = {(k, s): a for k, s, a in bag(sums, "k", "session_start", "amount")}
    assert have == {(k, s): total(v) for k, s, v in totals}


@pytest.mark.parametrize("hot_rows", LIMITS)
def test_ranks(df, rows, hot_rows):
    want = {}
    for g in by_key(rows).values():
        order = sorted(g, key=lambda r: (-r[2], r[0]))
        for i, r in enumerate(order):
            higher = [x[2] for x in g if x[2] > r[2]]
            want[r[0]] = (i + 1, len(higher) + 1, len(set(higher)) + 1)
    out = ranks(df, ["k"], "at", "id", cut(), hot_rows=hot_rows)
    have = {i: (a, b, c) for i, a, b, c in bag(out, "id", "row_number", "rank", "dense_rank")}
    assert have == want


@pytest.mark.parametrize("hot_rows", LIMITS)
def test_exact_median(df, rows, hot_rows):
    want = {
        k: statistics.median([r[3] for r in g if r[3] is not None]) for k, g in by_key(rows).items()
    }
    assert dict(bag(exact_median(df, ["k"], "v", 2, hot_rows), "k", "median")) == want


@pytest.mark.parametrize("hot_rows", LIMITS)
def test_version_at(spark, df, rows, hot_rows):
    versions = [("a", 5, 20, "x"), ("a", 20, 50, "y"), ("a", 70, None, "z"), ("b", 30, None, "w")]
    history = spark.createDataFrame(versions, "k STRING, effective_from BIGINT, effective_to BIGINT, tag STRING")
    want = {
        r[0]: next(
            (t for k, lo, hi, t in versions if k == r[1] and lo <= r[2] and (hi is None or r[2] < hi)), None
        )
        for r in rows
    }
    out = version_at(df, history, ["k"], "at", "id", ["tag"], cut(), hot_rows)
    assert dict(bag(out, "id", "tag")) == want


def test_latest_and_top_n(df, rows):
    want = {k: g[-1][0] for k, g in by_key(rows).items()}
    assert dict(bag(latest(df, ["k"], "at", "id"), "k", "id")) == want
    three = top_n(df, ["k"], [F.asc("at"), F.asc("id")], 3)
    assert bag(three, "id") == sorted((r[0],) for g in by_key(rows).values() for r in g[:3])


HARD = [
    (1, "a", 1, None), (2, "a", 2, None), (3, "a", 3, 1e-7), (4, "a", 4, 2e-7), (5, "a", 20, 1e25), (6, "a", 21, 4e-7),
    (7, "a", 40, float("nan")), (8, "a", 41, 5.0), (9, "a", 90, 7.0), (10, "b", 1, None), (11, None, 5, 2e-7),
]


@pytest.mark.parametrize("hot_rows", LIMITS)
def test_rolling_sums_of_tiny_large_and_nan_values(spark, hot_rows):
    hard = spark.createDataFrame(HARD, "id INT, k STRING, at BIGINT, v DOUBLE")
    plain = Window.partitionBy("k").orderBy("at").rangeBetween(-9, 0)
    want = bag(hard.select("id", F.sum("v").over(plain).cast("string"), F.count("v").over(plain)))
    out = rolling_sums(hard, ["k"], "at", cut(), "v", 9, "w", hot_rows)
    assert bag(out.select("id", F.col("w_sum").cast("string"), "w_n")) == want


@pytest.mark.parametrize("backwards", [False, True])
def test_ranks_with_nulls_hot_and_cold(spark, backwards):
    rows = [(i, "a", v) for i, v in enumerate([None, None, 5, 7, 7, 12, 31, 31, None])]
    df = spark.createDataFrame(rows, "id INT, k STRING, v BIGINT")
    by = F.floor(F.coalesce(F.col("v"), F.lit(-1)) / 10)
    hot, cold = (bag(ranks(df, ["k"], "v", "id", by, backwards, n), "id", "row_number", "rank", "dense_rank") for n in (1, 1_000_000))
    assert hot == cold
    order = F.col("v").desc() if backwards else F.col("v").asc()
    assert [(i, d) for i, _, _, d in hot] == bag(df.select("id", F.dense_rank().over(Window.partitionBy("k").orderBy(order))))


def test_median_of_a_key_without_values(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 1.0), ("b", 4.0), (None, 2.0)], "k STRING, v DOUBLE")
    assert bag(exact_median(df, ["k"], "v", 10.0)) == [(None, 2.0), ("a", None), ("b", 2.5)]


_PLACES = {
    "INT": [None, -25, -24, -10, -1, 0, 1, 2, 9, 10, 11, 19, 20, 500],
    "DOUBLE": [None, float("-inf"), -20.5, -10.0, -1e-20, 0.0, 0.25, 9.999, 10.0, 10.25, 1e9, float("inf"), float("nan")],
    "DECIMAL(12, 2)": [None, Decimal("-10.50"), Decimal("-0.50"), Decimal("0.00"), Decimal("9.50"), Decimal("10.00")],
}


@pytest.mark.parametrize("reach", [1, 10])
@pytest.mark.parametrize("kind", _PLACES)
def test_frames_of_hot_keys_equal_the_plain_window(spark, kind, reach):
    """Frames at and around the borders of blocks, of slices wider and narrower than a frame, and of lone times."""
    rnd = random.Random(7)
    rows = [(i, rnd.choice(["a", None]), at, rnd.choice([None, 1, 2, 4, 8])) for i, at in enumerate(_PLACES[kind] * 4)]
    df = spark.createDataFrame(rows, f"id INT, k STRING, at {kind}, v BIGINT")
    place = F.when(F.abs("at") < 1e12, F.col("at"))
    plain = Window.partitionBy("k").orderBy("at").rangeBetween(-reach, 0)
    want = bag(df.select("id", F.sum("v").over(plain).cast("double"), F.count("v").over(plain)))
    for width in (3, 1_000):
        out = rolling_sums(df, ["k"], "at", F.floor(place / width), "v", reach, "w", 1)
        assert bag(out, "id", "w_sum", "w_n") == want


def test_frames_of_a_hot_key_cost_its_times_once(spark):
    """No time is paired with slices or visited once per frame: 20 000 seconds, frames of 8 000, slices of 50."""
    df = spark.range(20_000).select(F.lit(1).alias("k"), F.col("id").alias("at"), F.lit(1).alias("v"))
    out = rolling_totals(df, ["k"], "at", time_slice("at", 50), "v", 8_000, "w", 1_000)
    assert out.where(F.col("w_n") != F.least(F.col("at") + 1, F.lit(8_001))).count() == 0 and out.count() == 20_000
    text = out._jdf.queryExecution().optimizedPlan().toString()
    # No join by range, and only the window of the other keys has a frame by range.
    assert not [line for line in text.splitlines() if "Join " in line and ">=" in line]
    assert text.count("RangeFrame") == 2  # sum and count
