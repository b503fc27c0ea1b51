"""Late rows kept aside, upserts into touched buckets only, and bucketed joins."""

from __future__ import annotations

import datetime as dt
import glob
import os
import random

from pyspark.sql import functions as F

from tests.conftest import bag
from tidewheel.plans.joins import bucketed_orders
from tidewheel.plans.registry import Tables
from tidewheel.sources.readers import new_files
from tidewheel.streaming.jobs import drain
from tidewheel.streaming.tables import merge_into_buckets, read_buckets, split_late, split_rows

T0 = dt.datetime(2024, 1, 1)


def at(s):
    return None if s is None else T0 + dt.timedelta(seconds=s)


def test_on_time_and_late_rows_are_the_input(spark, folder):
    schema = "id BIGINT, ts TIMESTAMP"
    deliveries = [
        [(0, 100), (1, 5), (2, None), (3, 100)],  # first delivery: nothing can be behind
        [(4, 39), (5, 40), (6, 500), (7, 41)],  # 60 s behind 100: 40 is on time, 39 is not
        [(8, 439), (9, 440), (9, 440), (10, 1)],
        [(11, 10_000)],
        [(12, 9_939), (13, 10_001)],
    ]
    late = {2, 4, 8, 10, 12}
    for n, rows in enumerate(deliveries):
        spark.createDataFrame([(i, at(s)) for i, s in rows], schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        if n != 2:  # deliveries 2 and 3 wait together for the next start
            source = new_files(spark, f"{folder}/in", schema, maxFilesPerTrigger=1)
            drain(source, split_late(f"{folder}/out", "ts", 60), f"{folder}/checkpoint")
    out = split_rows(spark, f"{folder}/out", schema)
    assert bag(out, "id", "ts") == bag(spark.read.parquet(f"{folder}/in"))
    assert sorted(r.id for r in out.where("is_late").collect()) == sorted(late)
    assert out.select("batch_id").distinct().count() == 5

    before = bag(out)
    again = spark.createDataFrame([(i, at(s)) for i, s in deliveries[1]], schema)
    split_late(f"{folder}/out", "ts", 60)(again, 1)  # a batch that runs again changes nothing
    assert bag(split_rows(spark, f"{folder}/out", schema)) == before


def folders(root):
    return {d.removeprefix(f"{root}/data/"): sorted(os.path.basename(f) for f in glob.glob(f"{d}/*.parquet")) for d in glob.glob(f"{root}/data/*/*")}


def test_upsert_touches_only_its_buckets(spark, folder):
    schema = "k BIGINT, ts BIGINT, v STRING"
    sink = merge_into_buckets(folder, ["k"], ("ts", "v"), n=8)
    state = {}

    def run(n, rows):
        sink(spark.createDataFrame(rows, schema), n)
        for k, ts, v in rows:
            if k is not None and (k not in state or (ts, v) > state[k]):
                state[k] = (ts, v)
        assert bag(read_buckets(spark, folder)) == sorted((k, *x) for k, x in state.items())

    rnd = random.Random(1)
    run(0, [(k, 5, f"a{k}") for k in range(200)] + [(None, 1, "no key")])
    first = folders(folder)
    assert len(first) == 8
    run(1, [(7, 9, "new"), (7, 6, "old"), (7, 4, "older")])
    second = folders(folder)
    assert {d: f for d, f in second.items() if d in first} == first and len(second) == 9
    run(2, [(7, 3, "late"), (500, 1, "x")])
    run(2, [(7, 3, "late"), (500, 1, "x")])
    for n in range(3, 7):
        run(n, [(rnd.randrange(200), n + 5, "z") for _ in range(3)])
    # old copies are released: two versions of a bucket at most
    assert max(sum(d.endswith(f"bucket={b}") for d in folders(folder)) for b in range(8)) <= 3
    untouched = [d for d in first if d in folders(folder)]
    assert all(folders(folder)[d] == first[d] for d in untouched)


def test_bucketed_tables_join_and_group_without_an_exchange(spark):
    joined = bucketed_orders(Tables(spark, "/root/testdata/sf0.001"))
    for df in (joined, joined.groupBy("o_orderkey").agg(F.sum("l_quantity"))):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in text and "SortMergeJoin" in text and "Bucketed: true" in text
