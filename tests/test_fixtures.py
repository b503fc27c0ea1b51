"""Small literal tables with worked results. The values below are fixed values."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import bag
from tidewheel.functions.times import epoch_seconds, time_slice
from tidewheel.operators.aggregates import exact_median, percent_of_total, pivot_sum
from tidewheel.operators.dedup import duplicate_keys, smallest_id
from tidewheel.operators.history import as_of, load_history
from tidewheel.operators.joins import without_match
from tidewheel.operators.upserts import upsert
from tidewheel.operators.windows import (
    latest,
    neighbour,
    ranks,
    rolling_average,
    rolling_totals,
    running_sums,
    runs,
    sessions,
)
from tidewheel.sources.readers import rows

DAY = 86_400


def day(month: int, d: int, year: int = 2026) -> dt.date:
    return dt.date(year, month, d)


@pytest.fixture(scope="module")
def orders(spark):
    values = [
        (1, 101, day(6, 1), "EU", 100.0),
        (2, 101, day(6, 3), "EU", 250.0),
        (3, 102, day(6, 1), "US", 175.0),
        (4, 102, day(6, 2), "US", 175.0),
        (5, 103, day(6, 4), "US", 50.0),
        (6, 104, day(6, 5), "EU", 0.0),
        (7, 104, day(6, 6), "EU", 999.0),
        (8, 105, day(6, 7), "APAC", None),
    ]
    return rows(spark, values, "order_id INT, customer_id INT, order_date DATE, region STRING, amount DOUBLE")


@pytest.fixture(scope="module")
def customers(spark):
    names = [(101, "Alice"), (102, "Bob"), (103, "Carol"), (104, "Dave"), (105, "Eve"), (999, "Ghost")]
    return rows(spark, names, "customer_id INT, name STRING")


def test_revenue_by_region(orders):
    out = orders.where(F.col("amount").isNotNull()).groupBy("region").agg(F.sum("amount").alias("r"))
    assert bag(out) == [("EU", 1349.0), ("US", 400.0)]


def test_latest_order(orders):
    out = latest(orders, ["customer_id"], "order_date", "order_id")
    assert bag(out, "order_id") == [(2,), (4,), (5,), (7,), (8,)]


def test_customers_without_orders(orders, customers):
    assert bag(without_match(customers, orders, ["customer_id"])) == [(999, "Ghost")]


def test_no_duplicates_apart_from_id(orders):
    same = ["customer_id", "order_date", "region", "amount"]
    assert smallest_id(orders, same, "order_id").count() == 8


@pytest.mark.parametrize("hot_rows", [1, 1_000_000])
def test_rolling_revenue_seven_days(orders, hot_rows):
    days = orders.withColumn("d", F.unix_date("order_date").cast("bigint"))
    out = rolling_totals(days, ["region"], "d", time_slice("d", 2), "amount", 6, "r", hot_rows)
    joined = days.join(out, ["region", "d"])
    want = [100.0, 350.0, 175.0, 350.0, 400.0, 350.0, 1349.0, None]
    assert bag(joined, "order_id", "r_sum") == list(enumerate(want, 1))


def test_percent_of_total(orders):
    per = orders.groupBy("customer_id").agg(F.sum("amount").alias("t"))
    out = percent_of_total(per, "t").withColumn("pct_of_total", F.round("pct_of_total", 4))
    assert dict(bag(out, "customer_id", "pct_of_total")) == {
        101: 20.0114, 102: 20.0114, 103: 2.8588, 104: 57.1184, 105: None,
    }


def test_median(orders):
    # the drill leaves out NULL amounts first; a key with NULLs only would otherwise have a median of NULL
    valued = orders.where("amount IS NOT NULL")
    assert bag(exact_median(valued, ["region"], "amount", 10), "region", "median") == [("EU", 175.0), ("US", 175.0)]


def test_pivot(orders):
    out = pivot_sum(orders, ["customer_id"], "region", ["EU", "US", "APAC"], F.sum("amount"))
    assert bag(out) == [
        (101, 350.0, None, None),
        (102, None, 350.0, None),
        (103, None, 50.0, None),
        (104, 999.0, None, None),
        (105, None, None, None),
    ]


def test_no_duplicate_ids(orders):
    assert duplicate_keys(orders, ["order_id"]).count() == 0


def test_one_run_per_customer(orders):
    changed = F.col("_prev").isNull() | (F.col("_prev") != F.col("region"))
    out = runs(orders, ["customer_id"], ["order_date", "order_id"], F.month("order_date"), F.col("region"), changed, "run")
    assert bag(out, "run") == [(1,)] * 8


@pytest.fixture(scope="module")
def amounts(spark):
    values = [
        (1, day(6, 1), 30.0), (1, day(6, 2), 10.0), (1, day(6, 5), 50.0), (2, day(6, 1), 20.0),
        (2, day(6, 3), 5.0), (2, day(6, 4), 15.0), (3, day(6, 2), 40.0),
    ]
    return rows(spark, values, "customer_id INT, ts DATE, amount DOUBLE").withColumn("sec", epoch_seconds("ts"))


@pytest.mark.parametrize("hot_rows", [1, 1_000_000])
def test_running_rolling_previous(amounts, hot_rows):
    keys, order, cut = ["customer_id"], ["sec"], time_slice("sec", DAY)
    out = running_sums(amounts, keys, order, cut, {"running": F.col("amount")}, hot_rows=hot_rows)
    assert [r[2] for r in bag(out, "customer_id", "ts", "running")] == [30, 40, 90, 20, 25, 40, 40]
    out = rolling_average(amounts, keys, "sec", cut, "amount", 7 * DAY, "avg", hot_rows)
    assert [round(r[2], 4) for r in bag(out, "customer_id", "ts", "avg")] == [30, 20, 30, 20, 12.5, 13.3333, 40]
    out = neighbour(amounts, keys, order, cut, {"prev": F.col("amount")}, hot_rows=hot_rows)
    assert [r[2] for r in bag(out, "customer_id", "ts", "prev")] == [None, 30, 10, None, 20, 5, None]


@pytest.mark.parametrize("hot_rows", [1, 1_000_000])
def test_seven_and_eight_day_frames_differ(amounts, spark, hot_rows):
    more = amounts.unionByName(
        rows(spark, [(3, day(6, 9), 2.0)], "customer_id INT, ts DATE, amount DOUBLE").withColumn("sec", epoch_seconds("ts"))
    )
    eight = rolling_average(more, ["customer_id"], "sec", time_slice("sec", DAY), "amount", 7 * DAY, "a", hot_rows)
    seven = rolling_average(more, ["customer_id"], "sec", time_slice("sec", DAY), "amount", 6 * DAY, "a", hot_rows)
    last = (F.col("customer_id") == 3) & (F.col("ts") == F.lit(day(6, 9)))
    assert eight.where(last).first()["a"] == 21.0
    assert seven.where(last).first()["a"] == 2.0


@pytest.mark.parametrize("hot_rows", [1, 1_000_000])
def test_rank_ties(spark, hot_rows):
    ties = rows(spark, [("A", 100), ("B", 100), ("C", 90), ("D", 80)], "name STRING, score INT").withColumn("g", F.lit(1))
    out = ranks(ties, ["g"], "score", "name", F.floor(F.col("score") / 10), hot_rows=hot_rows)
    assert bag(out, "name", "rank", "dense_rank", "row_number") == [
        ("A", 1, 1, 1), ("B", 1, 1, 2), ("C", 3, 2, 3), ("D", 4, 3, 4),
    ]


@pytest.mark.parametrize("hot_rows", [1, 1_000_000])
def test_click_sessions(spark, hot_rows):
    def at(h, m):
        return dt.datetime(2026, 6, 1, h, m)

    clicks = [
        (1, at(9, 0)), (1, at(9, 2)), (1, at(10, 0)), (1, at(10, 5)), (1, at(10, 35)), (2, at(9, 0)), (2, at(9, 45)),
    ]
    df = rows(spark, clicks, "user_id INT, ts TIMESTAMP_NTZ").withColumn("sec", epoch_seconds("ts"))
    df = df.withColumn("id", F.monotonically_increasing_id())
    out = sessions(df, ["user_id"], "sec", "id", time_slice("sec", 600), 1800, hot_rows=hot_rows)
    # The gap of exactly 30 minutes before 10:35 stays in the session.
    assert [r[2] for r in bag(out, "user_id", "ts", "session_id")] == [1, 1, 2, 2, 2, 1, 2]


HISTORY = "customer_id INT, name STRING, city STRING, effective_from DATE, effective_to DATE, is_current BOOLEAN"


@pytest.fixture(scope="module")
def dimension(spark):
    first = day(1, 1)
    return rows(
        spark,
        [(1, "Alice", "Seattle", first, None, True), (2, "Bob", "Boston", first, None, True), (3, "Carol", "Chicago", first, None, True)],
        HISTORY,
    )


def city_batch(spark, values):
    return rows(spark, values, "customer_id INT, name STRING, city STRING, effective_from DATE")


def test_history_load_and_reload(spark, dimension):
    new = day(6, 9)
    batch = city_batch(spark, [(1, "Alice", "Portland", new), (2, "Bob", "Boston", new), (4, "Dave", "Denver", new)])
    want = [
        (1, "Portland", new, None, True),
        (1, "Seattle", day(1, 1), new, False),
        (2, "Boston", day(1, 1), None, True),
        (3, "Chicago", day(1, 1), None, True),
        (4, "Denver", new, None, True),
    ]
    columns = ["customer_id", "city", "effective_from", "effective_to", "is_current"]
    once = load_history(dimension, batch, ["customer_id"], ["name", "city"])
    assert bag(once, *columns) == want
    assert bag(load_history(once, batch, ["customer_id"], ["name", "city"]), *columns) == want
    seen = as_of(once, F.lit(day(3, 5)))
    assert bag(seen, "city") == [("Boston",), ("Chicago",), ("Seattle",)]
    on_the_day = as_of(once, F.lit(new)).where("customer_id = 1")
    assert bag(on_the_day, "city") == [("Portland",)]


def test_history_null_changes_corrections_and_old_batches(spark, dimension):
    batch = city_batch(
        spark,
        [
            (1, "Alice", None, day(6, 9)),  # a value that goes missing is a change
            (2, "Bobby", "Boston", day(1, 1)),  # same first day: corrected in place
            (3, "Carol", "Cairo", day(12, 1, 2025)),  # older than the open row: ignored
        ],
    )
    out = load_history(dimension, batch, ["customer_id"], ["name", "city"])
    assert bag(out, "customer_id", "name", "city", "is_current") == [
        (1, "Alice", None, True),
        (1, "Alice", "Seattle", False),
        (2, "Bobby", "Boston", True),
        (3, "Carol", "Chicago", True),
    ]


def test_partial_upsert(spark):
    target = spark.range(1, 11).select(
        F.col("id").alias("order_id"),
        (F.col("id") % 10 + 1).cast("int").alias("customer_id"),
        (F.col("id") * 10.0).alias("amount"),
        F.lit("pending").alias("status"),
    )
    source = rows(spark, [(1, 999, 50.0, "shipped")], "order_id BIGINT, customer_id INT, amount DOUBLE, status STRING")
    changes = {"status": F.col("s.status"), "amount": F.col("s.amount")}
    out = upsert(target, source, ["order_id"], update=changes)
    assert out.count() == 10
    assert tuple(out.where("order_id = 1").first()) == (1, 2, 50.0, "shipped")
    assert tuple(out.where("order_id = 2").first()) == (2, 3, 20.0, "pending")


def test_temperatures(spark):
    values = [
        ("BLI", day(4, 3, 2021), 52, 43), ("BLI", day(4, 2, 2021), 50, 38), ("BLI", day(4, 1, 2021), 52, 41),
        ("PDX", day(4, 3, 2021), 64, 45), ("PDX", day(4, 2, 2021), 61, 41), ("PDX", day(4, 1, 2021), 66, 39),
        ("SEA", day(4, 3, 2021), 57, 43), ("SEA", day(4, 2, 2021), 54, 39), ("SEA", day(4, 1, 2021), 56, 41),
    ]
    rows(spark, values, "AirportCode STRING, Date DATE, TempHighF INT, TempLowF INT").createOrReplaceTempView("temps")
    out = spark.sql(
        """SELECT * FROM temps WHERE AirportCode <> 'BLI' AND Date > DATE '2021-04-01'
           GROUP BY AirportCode, Date, TempHighF, TempLowF ORDER BY TempHighF DESC"""
    )
    assert [(r[0], r[1].day, r[2], r[3]) for r in out.collect()] == [
        ("PDX", 3, 64, 45), ("PDX", 2, 61, 41), ("SEA", 3, 57, 43), ("SEA", 2, 54, 39),
    ]
