"""Join queries: every strategy must give the rows of the plain join."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.functions.sizes import row_bytes
from tidewheel.operators.history import version_at
from tidewheel.operators.joins import (
    co_partitioned_join,
    either_key_join,
    hot_salted_join,
    hot_split_join,
    left_join_flagged,
    needed_join,
    one_row_per_key_join,
    salted_join,
    small_side_join,
    without_match,
)
from tidewheel.operators.windows import neighbour
from tidewheel.plans.registry import Tables, query
from tidewheel.plans.reports import customer_regions
from tidewheel.sources.sinks import materialised, save_bucketed


def skewed_lines(t: Tables) -> DataFrame:
    """Order lines in which part 0 takes 40 % of all rows."""
    hot = F.pmod("l_orderkey", F.lit(10)) < 4
    return t.lineitem.select(
        F.when(hot, 0).otherwise(F.col("l_partkey")).alias("p_partkey"),
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
    )


SKEWED = """skewed AS (SELECT CASE WHEN l_orderkey % 10 < 4 THEN 0 ELSE l_partkey END AS p_partkey,
  l_orderkey, l_linenumber, l_quantity FROM lineitem)"""
_PLAIN = f"""WITH {SKEWED} SELECT p_partkey, l_orderkey, l_linenumber, l_quantity, p_name, p_type
  FROM skewed JOIN part USING (p_partkey)"""
_ORDERS_OF = """SELECT c_custkey, c_name, o_orderkey, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey"""


def keyed_orders(t: Tables) -> DataFrame:
    return t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice")


@query("jn_01_inner_join", _ORDERS_OF)
def inner_join(t: Tables) -> DataFrame:
    return keyed_orders(t).join(t.customer.select("c_custkey", "c_name"), "c_custkey")


@query("jn_02_broadcast_join", _ORDERS_OF)
def broadcast_join(t: Tables) -> DataFrame:
    return small_side_join(keyed_orders(t), t.customer.select("c_custkey", "c_name"), "c_custkey")


@query("jn_03_sort_merge_join", _ORDERS_OF)
def sort_merge_join(t: Tables) -> DataFrame:
    return keyed_orders(t).join(t.customer.select("c_custkey", "c_name").hint("merge"), "c_custkey")


@query("jn_04_shuffle_hash_join", _ORDERS_OF)
def shuffle_hash_join(t: Tables) -> DataFrame:
    return keyed_orders(t).join(t.customer.select("c_custkey", "c_name").hint("shuffle_hash"), "c_custkey")


_SUPPLY_SQL = """WITH a AS (SELECT l_partkey AS part, l_suppkey AS supp, count(*) AS sold FROM lineitem
    WHERE l_returnflag = 'N' GROUP BY 1, 2),
  b AS (SELECT l_partkey AS part, l_suppkey AS supp, count(*) AS returned FROM lineitem
    WHERE l_returnflag = 'R' GROUP BY 1, 2)
  SELECT part, supp, sold, returned FROM a {} JOIN b USING (part, supp)"""


def _supply(t: Tables, how: str) -> DataFrame:
    def counted(flag: str, name: str) -> DataFrame:
        return (
            t.lineitem.where(F.col("l_returnflag") == flag)
            .groupBy(F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supp"))
            .agg(F.count("*").alias(name))
        )

    return counted("N", "sold").join(counted("R", "returned"), ["part", "supp"], how)


@query("jn_05_multi_key_inner", _SUPPLY_SQL.format("INNER"))
def multi_key_inner(t: Tables) -> DataFrame:
    return _supply(t, "inner")


@query("jn_05_multi_key_left", _SUPPLY_SQL.format("LEFT"))
def multi_key_left(t: Tables) -> DataFrame:
    return _supply(t, "left")


@query("jn_05_multi_key_right", _SUPPLY_SQL.format("RIGHT"))
def multi_key_right(t: Tables) -> DataFrame:
    return _supply(t, "right")


@query("jn_05_multi_key_outer", _SUPPLY_SQL.format("FULL"))
def multi_key_outer(t: Tables) -> DataFrame:
    return _supply(t, "outer")


_LATE_ORDERS = "SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderdate >= TIMESTAMP '2001-03-01'"


def _late_orders(t: Tables) -> DataFrame:
    late = t.orders.where(F.col("o_orderdate") >= F.lit("2001-03-01").cast("timestamp_ntz"))
    return late.select(F.col("o_custkey").alias("c_custkey"))


@query("jn_06_left_semi", f"SELECT c_custkey, c_name FROM customer WHERE EXISTS ({_LATE_ORDERS})")
def left_semi(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", "c_name").join(_late_orders(t), "c_custkey", "left_semi")


@query("jn_07_left_anti", f"SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS ({_LATE_ORDERS})")
def left_anti(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", "c_name").join(_late_orders(t), "c_custkey", "left_anti")


_MAYBE = "CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_custkey END"


@query(
    "jn_08_null_safe_exclusion",
    f"""SELECT c_name, {_MAYBE} AS k FROM customer WHERE NOT EXISTS
        (SELECT 1 FROM orders WHERE o_orderdate >= TIMESTAMP '2001-03-01'
           AND (CASE WHEN o_custkey % 2 = 0 THEN NULL ELSE o_custkey END) = {_MAYBE})""",
)
def null_safe_exclusion(t: Tables) -> DataFrame:
    """NULLs on both sides: ``NOT IN`` would return nothing, the anti-join keeps them."""
    people = t.customer.select("c_name", F.when(F.col("c_custkey") % 3 != 0, F.col("c_custkey")).alias("k"))
    banned = _late_orders(t).select(F.when(F.col("c_custkey") % 2 != 0, F.col("c_custkey")).alias("k"))
    return without_match(people, banned, ["k"])


@query(
    "jn_09_expression_join",
    """SELECT n_nationkey AS id, n_name AS nation, r_regionkey AS region_id, r_name AS region
       FROM nation JOIN region ON n_regionkey = r_regionkey""",
)
def expression_join(t: Tables) -> DataFrame:
    nations = t.nation.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("fk"))
    regions = t.region.select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"))
    return nations.join(regions, nations["fk"] == regions["id"]).select(
        nations["id"], nations["name"].alias("nation"), regions["id"].alias("region_id"), regions["name"].alias("region")
    )


@query(
    "jn_10_self_join",
    """SELECT a.l_orderkey, a.l_linenumber, b.l_partkey AS next_part FROM lineitem a JOIN lineitem b
       ON a.l_orderkey = b.l_orderkey AND a.l_linenumber + 1 = b.l_linenumber""",
)
def self_join(t: Tables) -> DataFrame:
    a, b = t.lineitem.alias("a"), t.lineitem.alias("b")
    following = F.col("a.l_linenumber") + 1 == F.col("b.l_linenumber")
    return a.join(b, (F.col("a.l_orderkey") == F.col("b.l_orderkey")) & following).select(
        "a.l_orderkey", "a.l_linenumber", F.col("b.l_partkey").alias("next_part")
    )


def _parts(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", "p_name", "p_type")


@query("jn_11_salted_join", _PLAIN)
def salted(t: Tables) -> DataFrame:
    return salted_join(skewed_lines(t), _parts(t), ["p_partkey"], ["l_orderkey", "l_linenumber"])


@query("jn_12_hot_salted_join", _PLAIN)
def hot_salted(t: Tables) -> DataFrame:
    return hot_salted_join(skewed_lines(t), _parts(t), ["p_partkey"], ["l_orderkey", "l_linenumber"])


@query("jn_13_hot_split_join", _PLAIN)
def hot_split(t: Tables) -> DataFrame:
    return hot_split_join(skewed_lines(t), _parts(t), ["p_partkey"])


@query(
    "jn_14_aggregate_then_join",
    """SELECT r_name AS region, c_mktsegment AS segment, round(sum(o_totalprice), 2) AS revenue FROM orders
       JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2""",
)
def aggregate_then_join(t: Tables) -> DataFrame:
    per = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.sum("o_totalprice").alias("spent"))
    regions = customer_regions(t).select("c_custkey", "region")
    return (
        per.join(t.customer.select("c_custkey", "c_mktsegment"), "c_custkey")
        .join(regions, "c_custkey")
        .groupBy("region", F.col("c_mktsegment").alias("segment"))
        .agg(F.round(F.sum("spent"), 2).alias("revenue"))
    )


@query(
    "jn_15_unused_join_dropped",
    """SELECT l_returnflag, count(*) AS n_lines, round(sum(l_quantity), 2) AS quantity FROM lineitem
       JOIN part ON l_partkey = p_partkey GROUP BY 1""",
)
def unused_join_dropped(t: Tables) -> DataFrame:
    """No part column is used: the join is left out if it can neither lose nor repeat a line."""
    lines, keys = t.lineitem.withColumnRenamed("l_partkey", "p_partkey"), ["p_partkey"]
    return needed_join(lines, t.part.select(*keys), keys).groupBy("l_returnflag").agg(
        F.count("*").alias("n_lines"), F.round(F.sum("l_quantity"), 2).alias("quantity")
    )


@query(
    "jn_16_pruned_dimension",
    """SELECT p_type, p_brand, round(sum(l_extendedprice), 2) AS revenue FROM lineitem
       JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""",
)
def pruned_dimension(t: Tables) -> DataFrame:
    lines = t.lineitem.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.sum("l_extendedprice").alias("r"))
    dim = t.part.select("p_partkey", "p_type", "p_brand")
    return (
        small_side_join(lines, dim, "p_partkey")
        .groupBy("p_type", "p_brand")
        .agg(F.round(F.sum("r"), 2).alias("revenue"))
    )


@query(
    "jn_17_co_partitioned",
    """SELECT o_orderkey, o_custkey, l_linenumber, l_quantity FROM orders JOIN lineitem ON o_orderkey = l_orderkey""",
)
def co_partitioned(t: Tables) -> DataFrame:
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_quantity")
    n = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    return co_partitioned_join(t.orders.select("o_orderkey", "o_custkey"), lines, ["o_orderkey"], n)


def bucketed_orders(t: Tables) -> DataFrame:
    """Orders with their lines from two tables that share their buckets."""
    run = uuid.uuid4().hex
    names = {side: f"bucketed_{side}_{run}" for side in ("orders", "lines")}
    save_bucketed(t.orders.select("o_orderkey", "o_custkey"), names["orders"], ["o_orderkey"], 16)
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_quantity")
    save_bucketed(lines, names["lines"], ["o_orderkey"], 16)
    return t.spark.table(names["orders"]).join(t.spark.table(names["lines"]).hint("merge"), "o_orderkey")


@query(
    "jn_17_bucketed",
    """SELECT o_orderkey, o_custkey, l_linenumber, l_quantity FROM orders JOIN lineitem ON o_orderkey = l_orderkey""",
)
def bucketed(t: Tables) -> DataFrame:
    """Both tables written once in the same buckets; this join, and any later one, needs no exchange."""
    return bucketed_orders(t).select("o_orderkey", "o_custkey", "l_linenumber", "l_quantity")


@query(
    "jn_17_bucketed_totals",
    """SELECT o_orderkey, count(*) AS n_lines, sum(l_quantity) AS quantity FROM orders JOIN lineitem ON o_orderkey = l_orderkey
       GROUP BY 1""",
)
def bucketed_totals(t: Tables) -> DataFrame:
    """The aggregate after the join keeps the buckets as well."""
    return bucketed_orders(t).groupBy("o_orderkey").agg(F.count("*").alias("n_lines"), F.sum("l_quantity").alias("quantity"))


@query(
    "jn_18_fan_out_guard",
    """SELECT o_orderkey, o_totalprice, n_lines, quantity FROM orders LEFT JOIN
       (SELECT l_orderkey, count(*) AS n_lines, round(sum(l_quantity), 2) AS quantity FROM lineitem GROUP BY 1)
       ON o_orderkey = l_orderkey""",
)
def fan_out_guard(t: Tables) -> DataFrame:
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_quantity")
    measures = {"n_lines": F.count("*"), "quantity": F.round(F.sum("l_quantity"), 2)}
    return one_row_per_key_join(t.orders.select("o_orderkey", "o_totalprice"), lines, ["o_orderkey"], measures)


@query(
    "jn_19_keep_unmatched",
    """SELECT event_id, k, c_name, c_name IS NOT NULL AS matched FROM
         (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id END AS k FROM events)
       LEFT JOIN (SELECT c_custkey, c_name FROM customer) ON k = c_custkey""",
)
def keep_unmatched(t: Tables) -> DataFrame:
    keyed = t.events.select("event_id", F.when(F.col("event_id") % 3 != 0, F.col("event_id")).alias("k"))
    people = t.customer.select(F.col("c_custkey").alias("k"), "c_name")
    return left_join_flagged(keyed, people, ["k"])


@query(
    "jn_20_either_key",
    """SELECT event_id, user_id, c_custkey, c_name FROM events JOIN customer ON user_id = c_custkey OR event_id = c_custkey""",
)
def either_key(t: Tables) -> DataFrame:
    events = t.events.select("event_id", "user_id")
    people = t.customer.select("c_custkey", "c_name")
    pairs = [(F.col("user_id"), F.col("c_custkey")), (F.col("event_id"), F.col("c_custkey"))]
    return either_key_join(events, people, pairs)


@query(
    "jn_21_size_estimate",
    """SELECT count(*) AS n_rows, CAST(sum(16 + 8 + (strlen(c_name) + 8) + 4 + 8 + (strlen(c_mktsegment) + 8)) AS BIGINT)
         AS n_bytes FROM customer""",
)
def size_estimate(t: Tables) -> DataFrame:
    return t.customer.agg(F.count("*").alias("n_rows"), F.sum(row_bytes(t.customer)).alias("n_bytes"))


@query(
    "jn_22_version_at",
    """WITH h AS (SELECT o_custkey AS c, o_orderkey, o_orderstatus, o_orderdate AS effective_from,
         lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS effective_to FROM orders),
       f AS (SELECT l_orderkey, l_linenumber, l_suppkey % 1000 AS c, l_shipdate FROM lineitem)
       SELECT l_orderkey, l_linenumber, f.c, o_orderstatus AS status FROM f LEFT JOIN h ON f.c = h.c
         AND effective_from <= l_shipdate AND (effective_to IS NULL OR l_shipdate < effective_to)""",
)
def version_lookup(t: Tables) -> DataFrame:
    """Status of the newest order of a customer at each ship date."""
    orders = t.orders.select(
        F.col("o_custkey").alias("c"), "o_orderkey", F.col("o_orderstatus").alias("status"), F.col("o_orderdate").alias("effective_from")
    )
    history = neighbour(
        orders, ["c"], ["effective_from", "o_orderkey"], F.year("effective_from"), {"effective_to": F.col("effective_from")}, following=True
    )
    # Versions that another of the same day replaced were never valid.
    history = history.where(F.col("effective_to").isNull() | (F.col("effective_to") > F.col("effective_from")))
    history = materialised(history, "history")
    facts = t.lineitem.select(
        "l_orderkey", "l_linenumber", (F.col("l_suppkey") % 1000).alias("c"), F.col("l_shipdate").alias("at")
    )
    found = version_at(facts, history, ["c"], "at", "l_orderkey", ["status"], F.year("at"))
    return found.select("l_orderkey", "l_linenumber", "c", "status")
