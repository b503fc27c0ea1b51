from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import bag
from tidewheel.operators import incremental as inc
from tidewheel.operators.history import keep_first, keep_previous
from tidewheel.operators.upserts import (
    after_images,
    apply_changes,
    change_feed,
    insert_new,
    update_where,
    upsert,
    upsert_partitions,
)
from tidewheel.sources.sinks import create_database, write_partitioned


def table(spark, values):
    return spark.createDataFrame(values, "k INT, v STRING")


def test_upsert_null_values_and_null_keys(spark):
    target = table(spark, [(1, "a"), (2, "b"), (None, "n")])
    source = table(spark, [(2, None), (3, "c"), (None, "m")])
    want = [(None, "m"), (None, "n"), (1, "a"), (2, None), (3, "c")]
    assert bag(upsert(target, source, ["k"])) == want
    assert bag(insert_new(target, source, ["k"])) == [(None, "m"), (None, "n"), (1, "a"), (2, "b"), (3, "c")]


def test_upsert_twice_is_upsert_once(spark):
    target, source = table(spark, [(1, "a"), (2, "b")]), table(spark, [(2, "x"), (3, "c")])
    once = upsert(target, source, ["k"])
    assert bag(upsert(once, source, ["k"])) == bag(once) == [(1, "a"), (2, "x"), (3, "c")]


def test_repeated_source_keys(spark):
    target = spark.createDataFrame([(1, "a", 0)], "k INT, v STRING, at INT")
    source = spark.createDataFrame([(1, "old", 1), (1, "new", 2), (2, "p", 3), (2, "q", 3)], "k INT, v STRING, at INT")
    out = upsert(target, source, ["k"], newest=("at", "v"))
    assert bag(out) == [(1, "new", 2), (2, "q", 3)]


def test_delete_and_missing_source_columns(spark):
    target = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k INT, v STRING, n INT")
    source = spark.createDataFrame([(1, "x"), (2, "gone"), (3, "new")], "k INT, v STRING")
    out = upsert(target, source, ["k"], delete_when=F.col("s.v") == "gone")
    assert bag(out) == [(1, "x", 10), (3, "new", None)]


def test_changes_are_replayed(spark):
    target = table(spark, [(1, "a"), (2, "b"), (3, "c")])
    changes = spark.createDataFrame(
        [
            (1, "a2", "U", 1), (1, None, "D", 2),  # updated, then deleted
            (2, None, "D", 1), (2, "b2", "I", 2),  # deleted, then back
            (4, "d", "I", 1), (4, "d2", "U", 2),  # new, then updated
            (5, "e", "I", 1), (5, None, "D", 2),  # came and went
        ],
        "k INT, v STRING, op STRING, seq INT",
    )
    want = [(2, "b2"), (3, "c"), (4, "d2")]
    assert bag(apply_changes(target, changes, ["k"], "seq", "seq")) == want
    log = changes.select(
        F.when(F.col("op") == "D", F.struct("k", "v")).alias("before"),
        F.when(F.col("op") != "D", F.struct("k", "v")).alias("after"),
        "op",
        "seq",
        F.col("seq").alias("tie"),
    )
    images = after_images(log, "after", "op", "seq", "tie", ["k"], "before")
    assert bag(apply_changes(target, images, ["k"], "seq", "tie")) == want


def test_change_feed(spark):
    old, new = table(spark, [(1, "a"), (2, None), (3, "c"), (4, None)]), table(spark, [(1, "a"), (2, "b"), (4, None), (5, "e")])
    assert bag(change_feed(old, new, ["k"])) == [(2, "b", "update"), (3, "c", "delete"), (5, "e", "insert")]


def test_first_and_previous_values(spark):
    target, batch = table(spark, [(1, "a"), (2, "b")]), table(spark, [(1, "z"), (2, "b"), (3, "c")])
    assert bag(keep_first(target, batch, ["k"])) == [(1, "a"), (2, "b"), (3, "c")]
    wide = target.withColumn("prev", F.lit("p"))
    out = keep_previous(wide, batch, ["k"], "v", "prev")
    assert bag(out, "k", "v", "prev") == [(1, "z", "a"), (2, "b", "p"), (3, "c", None)]


def test_conditional_update(spark):
    out = update_where(table(spark, [(1, "a"), (2, None)]), F.col("v") == "a", {"v": F.upper("v")})
    assert bag(out) == [(1, "A"), (2, None)]


def test_partition_merge_moves_keys_and_drops_empty_partitions(spark, folder):
    create_database(spark, "tidewheel_test")
    path, name = f"{folder}/t", "tidewheel_test.by_day"
    write_partitioned(spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, "c", 2), (4, "d", 3)], "k INT, v STRING, d INT"), path, ["d"])
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} (k INT, v STRING, d INT) USING parquet PARTITIONED BY (d) LOCATION '{path}'")
    spark.sql(f"MSCK REPAIR TABLE {name}")
    batch = spark.createDataFrame([(3, "C", 3), (5, "e", 4)], "k INT, v STRING, d INT")
    for _ in range(2):
        upsert_partitions(spark, name, batch, ["k"], "d")
        assert bag(spark.table(name), "k", "v", "d") == [(1, "a", 1), (2, "b", 1), (3, "C", 3), (4, "d", 3), (5, "e", 4)]
    assert [r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()] == ["d=1", "d=3", "d=4"]


@pytest.mark.parametrize("kind", ["INT", "STRING"])
def test_null_partitions_keep_their_rows(spark, folder, kind):
    create_database(spark, "parts_" + kind.lower())
    name, one, two = f"parts_{kind.lower()}.t", *((1, 2) if kind == "INT" else ("a", "b"))
    schema = f"k INT, v INT, p {kind}"
    start = [(1, 10, None), (2, 20, None), (3, 30, one), (4, 40, two)]
    spark.createDataFrame(start, schema).write.partitionBy("p").saveAsTable(name)
    steps = [
        ([(1, 11, one)], [(1, 11, one), (2, 20, None), (3, 30, one), (4, 40, two)]),  # out of the NULL partition
        ([(4, 41, None)], [(1, 11, one), (2, 20, None), (3, 30, one), (4, 41, None)]),  # into it; another one empties
        ([(2, 21, one), (4, 42, one)], [(1, 11, one), (2, 21, one), (3, 30, one), (4, 42, one)]),  # it empties itself
        ([(9, 90, None)], [(1, 11, one), (2, 21, one), (3, 30, one), (4, 42, one), (9, 90, None)]),
    ]
    for batch, want in steps:
        for _ in range(2):
            upsert_partitions(spark, name, spark.createDataFrame(batch, schema), ["k"], "p")
            assert bag(spark.table(name), "k", "v", "p") == want


def test_a_batch_that_repeats_a_key_is_refused(spark):
    target, batch = table(spark, [(1, "a")]), table(spark, [(1, "x"), (1, "y"), (None, "n"), (None, "n")])
    with pytest.raises(Exception, match="repeats a key"):
        upsert(target, batch, ["k"]).collect()


def at(hour, minute=0):
    return dt.datetime(2024, 1, 1, hour, minute)


def test_marks(spark, folder):
    rows = spark.createDataFrame([(1, at(1)), (2, at(2)), (3, at(2))], "id INT, ts TIMESTAMP_NTZ")
    path = f"{folder}/marks"
    inc.save_mark(spark, path, "x", at(1))
    inc.save_mark(spark, path, "x", at(2))
    inc.save_mark(spark, path, "y", at(9))
    inc.save_mark(spark, path, "x", None)
    assert inc.read_mark(spark, path, "x") == at(2)
    assert inc.read_mark(spark, path, "z") is None
    assert inc.since(rows, "ts", None).count() == 3
    # Rows at the mark are read again: one of them may have come late.
    assert bag(inc.since(rows, "ts", at(2)), "id") == [(2,), (3,)]
    assert inc.next_mark(rows.limit(0), "ts") is None


@pytest.mark.parametrize("hot_rows", [1, 1_000_000])
def test_incremental_spend_equals_full_recompute(spark, hot_rows):
    values = [(i, i % 3, dt.datetime(2024, 1, 1) + dt.timedelta(hours=5 * i), float(i)) for i in range(60)]
    events = spark.createDataFrame(values, "id INT, u INT, ts TIMESTAMP_NTZ, v DOUBLE")
    full = inc.spend_of_new(events, "u", "ts", "v", None, hot_rows=hot_rows)
    mark = dt.datetime(2024, 1, 8)
    want = bag(full.where(F.col("ts") > F.lit(mark).cast("timestamp_ntz")), "id", "spend")
    assert want and bag(inc.spend_of_new(events, "u", "ts", "v", mark, hot_rows=hot_rows), "id", "spend") == want


def test_silver_keeps_valid_rows_once(spark):
    raw = spark.createDataFrame(
        [
            ("1", "7", "12.5", " CLICK ", "2024-01-01 10:00:00"),
            ("1", "7", "12.5", "click", "2024-01-01 10:00:00"),
            ("2", "7", "-3", "click", "2024-01-01 10:00:00"),
            ("3", "x", "4", "view", "not a time"),
            ("4", "7", "abc", "view", "2024-01-02 10:00:00"),
            ("5", "7", "1", "", "2024-01-02 10:00:00"),
            ("zz", "7", "1", "view", "2024-01-02 10:00:00"),
        ],
        "row_id STRING, user_id STRING, amount STRING, status STRING, ts STRING",
    )
    silver = inc.to_silver(raw, ["click", "view"])
    assert bag(silver, "row_id", "user_id", "amount", "status") == [(1, 7, 12.5, "click"), (3, None, 4.0, "view")]
    gold = inc.to_gold(silver)
    assert bag(gold, "status", "revenue", "n_orders") == [("click", 12.5, 1), ("view", 4.0, 1)]
