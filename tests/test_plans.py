"""Strategy claims, read from the plan text."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidewheel.operators import joins
from tidewheel.operators.upserts import upsert
from tidewheel.operators.windows import latest, running_sums
from tidewheel.plans import QUERIES
from tidewheel.plans.reports import year_range

BASE = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_prunes_and_pushes(spark):
    text = plan(QUERIES["rp_1_category_revenue"](spark, BASE))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate,1998-01-01T00:00), LessThan" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_extendedprice:double,l_discount:double>" in text
    assert "ReadSchema: struct<p_partkey:bigint,p_type:string>" in text
    assert "BroadcastHashJoin" in text


def test_year_filter_is_a_range(spark):
    orders = spark.read.parquet(f"{BASE}/orders.parquet")
    assert "PushedFilters: [IsNotNull(o_orderdate)" in plan(orders.where(year_range("o_orderdate", 1998)))


def test_join_strategies(spark):
    assert "SortMergeJoin" in plan(QUERIES["jn_03_sort_merge_join"](spark, BASE))
    assert "ShuffledHashJoin" in plan(QUERIES["jn_04_shuffle_hash_join"](spark, BASE))
    broadcast = plan(QUERIES["jn_02_broadcast_join"](spark, BASE))
    assert "BroadcastHashJoin" in broadcast and "Exchange hashpartitioning" not in broadcast


def test_salted_join_never_broadcasts_its_copies(spark):
    """Spark's size of the copied side does not count the copies, so it is left no choice."""
    text = plan(QUERIES["jn_11_salted_join"](spark, BASE))
    assert "SortMergeJoin" in text and "Broadcast" not in text


def test_aggregates_combine_before_the_shuffle(spark):
    text = plan(QUERIES["ag_13_partial_final"](spark, BASE))
    assert "partial_count" in text and text.count("Exchange") == 1


def test_limits_and_rank_filters_are_cut_early(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["so_02_top_k"](spark, BASE))
    text = plan(QUERIES["wn_01_latest_per_key"](spark, BASE))
    assert "WindowGroupLimit" in text and ", Partial" in text


def test_no_sort_without_need(spark):
    assert plan(QUERIES["so_05_unsorted"](spark, BASE)).count("Exchange") == 1


def test_small_batch_does_not_shuffle_the_table(spark):
    orders = spark.read.parquet(f"{BASE}/orders.parquet").select("o_orderkey", "o_totalprice")
    batch = spark.createDataFrame([(1, 2.0), (-5, 3.0)], "o_orderkey BIGINT, o_totalprice DOUBLE")
    kept = upsert(orders, batch, ["o_orderkey"], insert=False)
    assert "Exchange hashpartitioning" not in plan(kept) and "BroadcastHashJoin" in plan(kept)


def test_totals_are_scalar_subqueries(spark):
    text = plan(QUERIES["ag_11_percent_of_total"](spark, BASE))
    assert "Subquery" in text and "Window" not in text


def test_split_or_join_has_equi_joins_only(spark):
    text = plan(QUERIES["jn_20_either_key"](spark, BASE))
    assert "NestedLoop" not in text and text.count("HashJoin") == 2


def test_ordered_work_runs_per_slice(spark):
    df = spark.range(10).withColumn("k", F.lit(1))
    text = plan(running_sums(df, ["k"], ["id"], F.floor(F.col("id") / 3), {"s": F.col("id")}))
    assert "hashpartitioning(k" in text and "_slice" in text


@pytest.mark.parametrize("name", ["prj_08_one_select", "rp_6_taxed_measures", "dq_08_rules_from_config"])
def test_one_scan(spark, name):
    assert plan(QUERIES[name](spark, BASE)).count("FileScan") == 1


def test_latest_reads_only_its_columns(spark):
    events = spark.read.parquet(f"{BASE}/events.parquet").select("user_id", "ts", "event_id")
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint>" in plan(latest(events, ["user_id"], "ts", "event_id"))


def test_null_keys_do_not_meet_in_the_join(spark):
    left = spark.range(10).select("id", F.when(F.col("id") < 3, F.col("id")).alias("k"))
    text = plan(joins.left_join_flagged(left.hint("merge"), spark.range(5).select(F.col("id").alias("k")), ["k"]))
    assert "Union" in text and "Filter (id" in text


def test_key_shares_read_their_input_once(spark):
    """The total comes from the exchange of the counts."""
    from tidewheel.operators.skew import key_shares

    lines = spark.read.parquet(f"{BASE}/lineitem.parquet")
    shares = key_shares(lines, ["l_partkey"])
    shares.collect()
    text = plan(shares)
    assert "ReusedExchange" in text
