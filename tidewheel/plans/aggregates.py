"""Aggregation queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.functions.times import epoch_seconds, time_slice
from tidewheel.operators.aggregates import (
    counts_where,
    exact_median,
    percent_of_total,
    pivot_sum,
    salted_totals,
)
from tidewheel.operators.dedup import duplicate_keys
from tidewheel.operators.sketches import DISTINCT_BOUND, RANK_BOUND, merged_sketches, unit_sketches
from tidewheel.plans.joins import SKEWED, skewed_lines
from tidewheel.plans.registry import Tables, query
from tidewheel.plans.reports import net_price
from tidewheel.sources.sinks import materialised


@query("ag_01_sum_by_key", "SELECT l_returnflag, round(sum(l_extendedprice), 2) AS revenue FROM lineitem GROUP BY 1")
def sum_by_key(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag").agg(F.round(F.sum("l_extendedprice"), 2).alias("revenue"))


@query("ag_02_count_by_key", "SELECT event_type, count(*) AS n_events FROM events GROUP BY 1")
def count_by_key(t: Tables) -> DataFrame:
    return t.events.groupBy("event_type").agg(F.count("*").alias("n_events"))


@query(
    "ag_03_avg_min_max",
    """SELECT o_orderpriority, round(avg(o_totalprice), 4) AS mean, min(o_totalprice) AS low, max(o_totalprice) AS high,
         max(o_orderdate) AS newest FROM orders GROUP BY 1""",
)
def avg_min_max(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_orderpriority").agg(
        F.round(F.avg("o_totalprice"), 4).alias("mean"),
        F.min("o_totalprice").alias("low"),
        F.max("o_totalprice").alias("high"),
        F.max("o_orderdate").alias("newest"),
    )


@query(
    "ag_04_count_distinct",
    "SELECT event_type, count(DISTINCT user_id) AS users FROM events GROUP BY 1",
)
def count_distinct(t: Tables) -> DataFrame:
    return t.events.groupBy("event_type").agg(F.count_distinct("user_id").alias("users"))


@query("ag_05_approx_count_distinct")
def approx_count_distinct(t: Tables) -> DataFrame:
    return t.events.groupBy("event_type").agg(F.approx_count_distinct("user_id", 0.05).alias("users"))


@query("ag_06_approx_median")
def approx_median(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_orderpriority").agg(
        F.percentile_approx("o_totalprice", 0.5, 10_000).alias("median_approx")
    )


def _day_sketches(t: Tables) -> DataFrame:
    """One row per day, written; the queries below read these rows only."""
    day = time_slice(epoch_seconds("ts"), 86_400)
    return materialised(unit_sketches(t.events, day, "user_id", "value"), "day-sketches")


_WEEK = "CAST(floor(epoch(ts) / 604800) AS BIGINT)"
_DAY = "CAST(floor(epoch(ts) / 86400) AS BIGINT)"


@query(
    "ag_05_merged_distinct_sketches",
    f"""SELECT {_WEEK} AS week, count(DISTINCT {_DAY}) AS n_days, count(*) AS n_events, count(DISTINCT user_id) AS users,
       true AS within_bound FROM events GROUP BY 1""",
)
def merged_distinct_sketches(t: Tables) -> DataFrame:
    """Users of each week from seven stored sketches, beside the exact number and the promised bound."""
    merged = merged_sketches(_day_sketches(t), F.floor(F.col("unit") / 7)).withColumnRenamed("span", "week")
    exact = t.events.groupBy(time_slice(epoch_seconds("ts"), 604_800).alias("week")).agg(F.count_distinct("user_id").alias("users"))
    near = F.abs(F.col("distinct") - F.col("users")) <= F.ceil(F.col("users") * DISTINCT_BOUND)
    return merged.join(exact, "week").select(
        "week", F.col("n_units").alias("n_days"), F.col("n_rows").alias("n_events"), "users", near.alias("within_bound")
    )


@query(
    "ag_06_merged_quantile_sketches",
    f"SELECT {_WEEK} AS week, count(DISTINCT {_DAY}) AS n_days, count(value) AS n_values, true AS within_bound FROM events GROUP BY 1",
)
def merged_quantile_sketches(t: Tables) -> DataFrame:
    """Median of each week from stored sketches; its true rank must lie within the promised bound."""
    merged = merged_sketches(_day_sketches(t), F.floor(F.col("unit") / 7)).withColumnRenamed("span", "week")
    rows = t.events.select(time_slice(epoch_seconds("ts"), 604_800).alias("week"), "value").join(merged, "week")
    counted = rows.groupBy("week", F.col("n_units").alias("n_days")).agg(
        F.count("value").alias("n_values"), F.count_if(F.col("value") < F.col("quantile")).alias("below"),
        F.count_if(F.col("value") <= F.col("quantile")).alias("upto"),
    )
    low, high = (0.5 - RANK_BOUND) * F.col("n_values"), (0.5 + RANK_BOUND) * F.col("n_values")
    near = (F.col("below") <= high) & (F.col("upto") >= low)
    return counted.select("week", "n_days", "n_values", near.alias("within_bound"))


@query(
    "ag_06_exact_median",
    "SELECT o_orderpriority, round(quantile_cont(o_totalprice, 0.5), 4) AS median FROM orders GROUP BY 1",
)
def median(t: Tables) -> DataFrame:
    found = exact_median(t.orders, ["o_orderpriority"], "o_totalprice", 1000)
    return found.withColumn("median", F.round("median", 4))


@query(
    "ag_07_global",
    "SELECT count(*) AS n_lines, round(sum(l_quantity), 2) AS quantity, max(l_shipdate) AS newest FROM lineitem",
)
def global_aggregate(t: Tables) -> DataFrame:
    return t.lineitem.agg(
        F.count("*").alias("n_lines"), F.round(F.sum("l_quantity"), 2).alias("quantity"), F.max("l_shipdate").alias("newest")
    )


@query(
    "ag_08_conditional_counts",
    """SELECT l_returnflag, count(*) FILTER (l_discount > 0.05) AS discounted, count(*) FILTER (l_quantity < 10) AS small,
         count(*) FILTER (l_tax = 0) AS untaxed FROM lineitem GROUP BY 1""",
)
def conditional_counts(t: Tables) -> DataFrame:
    conditions = {
        "discounted": F.col("l_discount") > 0.05,
        "small": F.col("l_quantity") < 10,
        "untaxed": F.col("l_tax") == 0,
    }
    return t.lineitem.groupBy("l_returnflag").agg(*counts_where(conditions))


@query(
    "ag_09_having",
    "SELECT l_orderkey, l_partkey, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def having(t: Tables) -> DataFrame:
    return duplicate_keys(t.lineitem, ["l_orderkey", "l_partkey"])


@query(
    "ag_10_pivot",
    """SELECT user_id, round(sum(value) FILTER (event_type = 'click'), 2) AS click,
         round(sum(value) FILTER (event_type = 'purchase'), 2) AS purchase FROM events GROUP BY 1""",
)
def pivot(t: Tables) -> DataFrame:
    return pivot_sum(t.events, ["user_id"], "event_type", ["click", "purchase"], F.round(F.sum("value"), 2))


@query(
    "ag_11_percent_of_total",
    """WITH per AS (SELECT l_suppkey, sum(CAST(l_quantity AS BIGINT)) AS quantity FROM lineitem GROUP BY 1)
       SELECT l_suppkey, CAST(quantity AS BIGINT) AS quantity,
         100.0e0 * quantity / (SELECT CAST(sum(quantity) AS BIGINT) FROM per) AS pct_of_total FROM per""",
)
def percent(t: Tables) -> DataFrame:
    per = t.lineitem.groupBy("l_suppkey").agg(F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"))
    return percent_of_total(per, "quantity")


@query(
    "ag_12_salted_totals",
    f"""WITH {SKEWED} SELECT p_partkey, sum(l_quantity) AS total, count(*) AS n_values, sum(l_quantity) / count(*) AS mean
        FROM skewed GROUP BY 1""",
)
def salted_aggregate(t: Tables) -> DataFrame:
    return salted_totals(skewed_lines(t), ["p_partkey"], "l_quantity", ["l_orderkey", "l_linenumber"])


@query(
    "ag_13_partial_final",
    f"""WITH {SKEWED} SELECT p_partkey, count(*) AS n_lines, sum(l_quantity) AS quantity FROM skewed GROUP BY 1""",
)
def partial_final(t: Tables) -> DataFrame:
    """Spark adds up per task before the shuffle: the hot key sends one row per task."""
    return skewed_lines(t).groupBy("p_partkey").agg(
        F.count("*").alias("n_lines"), F.sum("l_quantity").alias("quantity")
    )


@query(
    "ag_14_collected",
    """SELECT o_custkey, list_sort(list_distinct(list(o_orderpriority))) AS priorities,
         list_sort(list(DISTINCT year(o_orderdate)::INTEGER)) AS years FROM orders GROUP BY 1""",
)
def collected(t: Tables) -> DataFrame:
    """Sets of bounded size: five priorities, and the years of the calendar."""
    return t.orders.groupBy("o_custkey").agg(
        F.sort_array(F.collect_set("o_orderpriority")).alias("priorities"),
        F.sort_array(F.collect_set(F.year("o_orderdate"))).alias("years"),
    )


@query(
    "ag_14_collect_list",
    """SELECT l_orderkey, list_sort(list(l_linenumber)) AS line_numbers FROM lineitem GROUP BY 1""",
)
def collect_list(t: Tables) -> DataFrame:
    """A list per order: an order has few lines, so the lists are short."""
    return t.lineitem.groupBy("l_orderkey").agg(
        F.sort_array(F.collect_list("l_linenumber")).alias("line_numbers")
    )


@query("ag_15_dict_aggregate", "SELECT c_mktsegment, count(c_custkey) AS n, max(c_acctbal) AS top FROM customer GROUP BY 1")
def dict_aggregate(t: Tables) -> DataFrame:
    grouped = t.customer.groupBy("c_mktsegment").agg({"c_custkey": "count", "c_acctbal": "max"})
    return grouped.withColumnsRenamed({"count(c_custkey)": "n", "max(c_acctbal)": "top"})


@query("ag_16_group_all", "SELECT l_returnflag, l_linestatus, l_tax FROM lineitem GROUP BY 1, 2, 3")
def group_all(t: Tables) -> DataFrame:
    t.lineitem.createOrReplaceTempView("tidewheel_lines")
    return t.spark.sql(
        "SELECT l_returnflag, l_linestatus, l_tax FROM tidewheel_lines GROUP BY l_returnflag, l_linestatus, l_tax"
    )


@query(
    "ag_17_bucket_counts",
    """SELECT CASE WHEN o_totalprice < 100000 THEN 'low' WHEN o_totalprice < 300000 THEN 'mid' ELSE 'high' END AS bucket,
         count(*) AS n_orders FROM orders GROUP BY 1""",
)
def bucket_counts(t: Tables) -> DataFrame:
    price = F.col("o_totalprice")
    bucket = F.when(price < 100000, "low").when(price < 300000, "mid").otherwise("high")
    return t.orders.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n_orders"))


@query(
    "ag_18_merged_aggregates",
    """SELECT l_linestatus, count(*) AS n_lines, round(sum(l_quantity), 2) AS quantity, round(sum(l_extendedprice), 2) AS gross,
         CAST(sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18, 4))) AS DOUBLE) AS net, count(DISTINCT l_orderkey) AS n_orders,
         round(avg(l_discount), 6) AS discount FROM lineitem GROUP BY 1""",
)
def merged_aggregates(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_linestatus").agg(
        F.count("*").alias("n_lines"),
        F.round(F.sum("l_quantity"), 2).alias("quantity"),
        F.round(F.sum("l_extendedprice"), 2).alias("gross"),
        F.sum(net_price()).cast("double").alias("net"),
        F.count_distinct("l_orderkey").alias("n_orders"),
        F.round(F.avg("l_discount"), 6).alias("discount"),
    )
