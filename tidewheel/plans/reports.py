"""Whole reports: revenue by category, top customers, segments, taxed measures, drills."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.functions.text import clean
from tidewheel.functions.times import epoch_seconds, time_slice
from tidewheel.operators.aggregates import exact_median, percent_of_total, pivot_sum
from tidewheel.operators.dedup import duplicate_keys, smallest_id
from tidewheel.operators.joins import without_match
from tidewheel.operators.windows import latest, rolling_totals, runs, top_n
from tidewheel.plans.registry import Tables, query

DAY = 86_400


def year_range(col: str, year: int) -> Column:
    """A year as a range on the stored column, so that the filter reaches the Parquet scan."""
    first = F.lit(f"{year}-01-01").cast("timestamp_ntz")
    after = F.lit(f"{year + 1}-01-01").cast("timestamp_ntz")
    return (F.col(col) >= first) & (F.col(col) < after)


def net_price() -> Column:
    """Discounted price as a decimal with all its four places: sums are exact in any order."""
    return (F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("decimal(18,4)")


def sales(t: Tables, year: int) -> DataFrame:
    """Lines of one year's orders with their customer and revenue."""
    orders = t.orders.where(year_range("o_orderdate", year)).select("o_orderkey", "o_custkey")
    lines = t.lineitem.select(
        "l_orderkey",
        "l_partkey",
        net_price().alias("revenue"),
    )
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_partkey", "o_custkey", "revenue"
    )


_SALES_SQL = """
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1999-01-01'
"""


@query(
    "rp_1_category_revenue",
    f"""SELECT lower(trim(p_type)) AS category,
               CAST(sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18, 4))) AS DOUBLE) AS revenue,
               count(DISTINCT o_custkey) AS customers
        {_SALES_SQL} GROUP BY 1""",
)
def category_revenue(t: Tables) -> DataFrame:
    parts = t.part.select("p_partkey", clean("p_type").alias("category"))
    return (
        sales(t, 1998)
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("category")
        .agg(
            F.sum("revenue").cast("double").alias("revenue"),
            F.count_distinct("o_custkey").alias("customers"),
        )
        .orderBy(F.desc("revenue"))
    )


@query(
    "rp_2_category_product_revenue",
    f"""SELECT lower(trim(p_type)) AS category, p_name AS product,
               CAST(sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18, 4))) AS DOUBLE) AS revenue
        {_SALES_SQL} GROUP BY 1, 2""",
)
def category_product_revenue(t: Tables) -> DataFrame:
    parts = t.part.select("p_partkey", clean("p_type").alias("category"), F.col("p_name").alias("product"))
    return (
        sales(t, 1998)
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("category", "product")
        .agg(F.sum("revenue").cast("double").alias("revenue"))
        .orderBy(F.desc("revenue"))
    )


def customer_regions(t: Tables) -> DataFrame:
    nations = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return (
        t.customer.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", "c_name", F.col("r_name").alias("region"))
    )


@query(
    "rp_3_top_customer_per_region",
    """WITH per AS (SELECT o_custkey, round(sum(o_totalprice), 2) AS revenue FROM orders GROUP BY 1),
            named AS (SELECT r_name AS region, c_custkey AS customer_id, c_name AS customer, revenue,
                 row_number() OVER (PARTITION BY r_name ORDER BY revenue DESC, c_custkey) AS rn
               FROM per JOIN customer ON o_custkey = c_custkey
               JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
       SELECT region, customer_id, customer, revenue FROM named WHERE rn = 1""",
)
def top_customer_per_region(t: Tables) -> DataFrame:
    per_customer = t.orders.groupBy("o_custkey").agg(
        F.round(F.sum("o_totalprice"), 2).alias("revenue")
    )
    named = per_customer.join(customer_regions(t), F.col("o_custkey") == F.col("c_custkey")).select(
        "region", F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer"), "revenue"
    )
    return top_n(named, ["region"], [F.desc("revenue"), F.asc("customer_id")], 1)


@query(
    "rp_5_segment_revenue",
    """SELECT c_mktsegment AS segment, round(sum(o_totalprice), 2) AS revenue
       FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""",
)
def segment_revenue(t: Tables) -> DataFrame:
    per_customer = t.orders.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("revenue"))
    return (
        per_customer.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(F.col("c_mktsegment").alias("segment"))
        .agg(F.round(F.sum("revenue"), 2).alias("revenue"))
    )


@query(
    "rp_6_taxed_measures",
    """SELECT count(*) AS n_orders, count(*) FILTER (o_totalprice * 1.2e0 > 300000) AS n_large,
              round(sum(o_totalprice * 1.2e0), 2) AS taxed_total FROM orders""",
)
def taxed_measures(t: Tables) -> DataFrame:
    taxed = t.orders.select((F.col("o_totalprice") * 1.2).alias("taxed"))
    return taxed.agg(
        F.count("*").alias("n_orders"),
        F.count_if(F.col("taxed") > 300000).alias("n_large"),
        F.round(F.sum("taxed"), 2).alias("taxed_total"),
    )


@query(
    "rp_9_filtered_grouped_sorted",
    """SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS day, max(o_totalprice) AS high, min(o_totalprice) AS low FROM orders
       WHERE o_orderpriority <> '5-LOW' AND o_orderdate > TIMESTAMP '2001-01-01' GROUP BY 1, 2""",
)
def filtered_grouped_sorted(t: Tables) -> DataFrame:
    """Highs and lows per group after a date, the highest first, as SQL over a view."""
    t.orders.createOrReplaceTempView("tidewheel_highs")
    return t.spark.sql(
        """SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS day, max(o_totalprice) AS high, min(o_totalprice) AS low
           FROM tidewheel_highs WHERE o_orderpriority <> '5-LOW' AND o_orderdate > TIMESTAMP_NTZ '2001-01-01'
           GROUP BY ALL ORDER BY high DESC"""
    )


# ---- SQL drills over orders, with the customer's region as the region of an order ----


def regional_orders(t: Tables) -> DataFrame:
    return t.orders.join(customer_regions(t), F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "o_custkey", "o_orderdate", "region", "o_totalprice"
    )


_REGIONAL = """WITH ro AS (SELECT o_orderkey, o_custkey, o_orderdate, r_name AS region, o_totalprice
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)"""


@query(
    "rp_8_q1_revenue_per_region",
    f"""{_REGIONAL} SELECT region, round(sum(o_totalprice), 2) AS revenue FROM ro
        WHERE o_totalprice IS NOT NULL GROUP BY region""",
)
def q1(t: Tables) -> DataFrame:
    return (
        regional_orders(t)
        .where(F.col("o_totalprice").isNotNull())
        .groupBy("region")
        .agg(F.round(F.sum("o_totalprice"), 2).alias("revenue"))
        .orderBy(F.desc("revenue"))
    )


@query(
    "rp_8_q2_latest_order",
    """SELECT o_custkey, o_orderkey, o_orderdate FROM (SELECT *, row_number() OVER
         (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
       WHERE rn = 1""",
)
def q2(t: Tables) -> DataFrame:
    wanted = t.orders.select("o_custkey", "o_orderkey", "o_orderdate")
    return latest(wanted, ["o_custkey"], "o_orderdate", "o_orderkey")


@query(
    "rp_8_q3_customers_without_orders",
    """SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders
         WHERE o_custkey = c_custkey AND o_orderdate >= TIMESTAMP '2001-01-01')""",
)
def q3(t: Tables) -> DataFrame:
    recent = t.orders.where(F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz"))
    customers = t.customer.select("c_custkey", "c_name")
    return without_match(customers, recent.withColumnRenamed("o_custkey", "c_custkey"), ["c_custkey"])


@query(
    "rp_8_q4_deduplicated_lines",
    """SELECT min(l_linenumber) AS l_linenumber, l_orderkey, l_partkey, l_suppkey FROM lineitem
       GROUP BY l_orderkey, l_partkey, l_suppkey""",
)
def q4(t: Tables) -> DataFrame:
    return smallest_id(t.lineitem, ["l_orderkey", "l_partkey", "l_suppkey"], "l_linenumber")


@query(
    "rp_8_q5_rolling_revenue",
    f"""{_REGIONAL} SELECT o_orderkey, region, o_orderdate, round(sum(o_totalprice) OVER (PARTITION BY region
          ORDER BY o_orderdate RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW), 2) AS rev_7d
        FROM ro""",
)
def q5(t: Tables) -> DataFrame:
    timed = regional_orders(t).withColumn("at", epoch_seconds("o_orderdate"))
    rolled = rolling_totals(
        timed, ["region"], "at", time_slice("at", 30 * DAY), "o_totalprice", 6 * DAY, "rev"
    )
    # Few (region, day) totals against many orders: Spark broadcasts them while they are small
    # and splits skewed partitions when they are not.
    rolled = timed.join(rolled, ["region", "at"])
    return rolled.select("o_orderkey", "region", "o_orderdate", F.round("rev_sum", 2).alias("rev_7d"))


@query(
    "rp_8_q6_percent_of_total",
    """WITH per AS (SELECT o_custkey, round(sum(o_totalprice), 2) AS spent FROM orders GROUP BY 1)
       SELECT o_custkey, spent, round(100.0e0 * spent / (SELECT sum(spent) FROM per), 6) AS pct_of_total
       FROM per""",
)
def q6(t: Tables) -> DataFrame:
    per = t.orders.groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("spent"))
    return percent_of_total(per, "spent").withColumn("pct_of_total", F.round("pct_of_total", 6))


@query(
    "rp_8_q7_exact_median",
    f"""{_REGIONAL} SELECT region, round(quantile_cont(o_totalprice, 0.5), 4) AS median FROM ro GROUP BY 1""",
)
def q7(t: Tables) -> DataFrame:
    found = exact_median(regional_orders(t), ["region"], "o_totalprice", 1000)
    return found.withColumn("median", F.round("median", 4))


@query(
    "rp_8_q8_pivot",
    f"""{_REGIONAL} SELECT o_custkey,
          round(sum(o_totalprice) FILTER (region = 'EUROPE'), 2) AS "EUROPE",
          round(sum(o_totalprice) FILTER (region = 'ASIA'), 2) AS "ASIA",
          round(sum(o_totalprice) FILTER (region = 'AMERICA'), 2) AS "AMERICA"
        FROM ro GROUP BY 1""",
)
def q8(t: Tables) -> DataFrame:
    return pivot_sum(
        regional_orders(t),
        ["o_custkey"],
        "region",
        ["EUROPE", "ASIA", "AMERICA"],
        F.round(F.sum("o_totalprice"), 2),
    )


@query(
    "rp_8_q9_duplicate_keys",
    """SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2
       HAVING count(*) > 1""",
)
def q9(t: Tables) -> DataFrame:
    return duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "rp_8_q10_status_runs",
    """WITH f AS (SELECT o_custkey, o_orderkey, o_orderdate, o_orderstatus,
         lag(o_orderstatus) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS prev FROM orders)
       SELECT o_custkey, o_orderkey, o_orderstatus, CAST(sum(CASE WHEN prev IS NULL OR prev <> o_orderstatus
         THEN 1 ELSE 0 END) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
         ROWS UNBOUNDED PRECEDING) AS BIGINT) AS run_id FROM f""",
)
def q10(t: Tables) -> DataFrame:
    orders = t.orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus")
    changed = F.col("_prev").isNull() | (F.col("_prev") != F.col("o_orderstatus"))
    numbered = runs(
        orders,
        ["o_custkey"],
        ["o_orderdate", "o_orderkey"],
        F.year("o_orderdate"),
        F.col("o_orderstatus"),
        changed,
        "run_id",
    )
    return numbered.select("o_custkey", "o_orderkey", "o_orderstatus", "run_id")
