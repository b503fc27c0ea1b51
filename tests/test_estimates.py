"""Approximate results within their tolerance, repeatable samples, times in any session zone."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import bag
from tidewheel.functions.times import epoch_seconds
from tidewheel.plans import QUERIES

BASE = "/root/testdata/sf0.01"


def test_approximate_distinct_count(spark):
    near = dict(bag(QUERIES["ag_05_approx_count_distinct"](spark, BASE)))
    exact = dict(bag(QUERIES["ag_04_count_distinct"](spark, BASE)))
    assert near.keys() == exact.keys()
    assert all(abs(near[k] - exact[k]) <= 0.2 * exact[k] for k in exact)


def test_approximate_median(spark):
    near = dict(bag(QUERIES["ag_06_approx_median"](spark, BASE)))
    exact = dict(bag(QUERIES["ag_06_exact_median"](spark, BASE)))
    assert near.keys() == exact.keys()
    assert all(abs(near[k] - exact[k]) <= 0.01 * exact[k] for k in exact)


def test_samples_and_salts_repeat(spark):
    for name in ("flt_8_sample", "fn_11_rand"):
        assert bag(QUERIES[name](spark, BASE)) == bag(QUERIES[name](spark, BASE))
    share = QUERIES["flt_8_sample"](spark, BASE).count() / spark.read.parquet(f"{BASE}/lineitem.parquet").count()
    assert 0.09 < share < 0.11


def test_partition_rows_add_up(spark):
    total = QUERIES["pt_01_partition_rows"](spark, BASE).agg(F.sum("n_rows")).first()[0]
    assert total == spark.read.parquet(f"{BASE}/lineitem.parquet").count()
    assert QUERIES["pt_02_partition_count"](spark, BASE).first()[0] == 6


def test_clustered_layout_hits_few_files(spark):
    assert QUERIES["tbl_19_files_hit"](spark, BASE).count() <= 4


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_epoch_seconds_in_any_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    times = [
        (dt.datetime(2024, 7, 1, 12, 0, 0, 500_000), 1_719_835_200),
        (dt.datetime(2024, 3, 10, 2, 30), 1_710_037_800),
        (dt.datetime(1969, 12, 31, 23, 59, 59, 900_000), -1),
    ]
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame(times, "ts TIMESTAMP_NTZ, want BIGINT")
        assert df.where(epoch_seconds("ts") != F.col("want")).count() == 0
        assert dict(df.select(epoch_seconds("ts").alias("s")).dtypes) == {"s": "bigint"}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
