"""Window queries, all through the seeded operators unless a rank filter makes them cheap."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.functions.times import epoch_seconds, time_slice
from tidewheel.operators.aggregates import percent_of_total
from tidewheel.operators.windows import (
    latest,
    moving_average,
    neighbour,
    ranks,
    rolling_sums,
    rolling_totals,
    running_sums,
    runs,
    sessions,
    top_n,
)
from tidewheel.plans.registry import Tables, query
from tidewheel.plans.reports import customer_regions

HOUR, DAY = 3_600, 86_400


def timed_events(t: Tables) -> DataFrame:
    return t.events.select("event_id", "user_id", "ts", "event_type", "value", epoch_seconds("ts").alias("sec"))


_SEC = "CAST(floor(epoch(ts)) AS BIGINT)"
_EV = f"WITH e AS (SELECT event_id, user_id, ts, event_type, value, {_SEC} AS sec FROM events)"


@query(
    "wn_01_latest_per_key",
    """SELECT user_id, event_id, ts, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id
         ORDER BY ts DESC NULLS LAST, event_id DESC) AS rn FROM events) WHERE rn = 1""",
)
def latest_per_key(t: Tables) -> DataFrame:
    return latest(t.events.select("user_id", "event_id", "ts", "value"), ["user_id"], "ts", "event_id")


@query(
    "wn_02_ranks",
    """SELECT l_suppkey, l_orderkey * 10 + l_linenumber AS line, l_quantity,
         CAST(row_number() OVER (PARTITION BY l_suppkey ORDER BY l_quantity DESC, l_orderkey * 10 + l_linenumber) AS INTEGER) AS row_number,
         CAST(rank() OVER w AS INTEGER) AS rank, CAST(dense_rank() OVER w AS INTEGER) AS dense_rank
       FROM lineitem WINDOW w AS (PARTITION BY l_suppkey ORDER BY l_quantity DESC)""",
)
def tie_ranks(t: Tables) -> DataFrame:
    lines = t.lineitem.select(
        "l_suppkey", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line"), "l_quantity"
    )
    return ranks(lines, ["l_suppkey"], "l_quantity", "line", F.floor("l_quantity"))


@query(
    "wn_03_top_n_per_group",
    """WITH per AS (SELECT r_name AS region, c_custkey, round(sum(o_totalprice), 2) AS revenue FROM orders
         JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
         JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2)
       SELECT region, c_custkey, revenue FROM (SELECT *, row_number() OVER (PARTITION BY region
         ORDER BY revenue DESC, c_custkey) AS rn FROM per) WHERE rn <= 3""",
)
def top_three(t: Tables) -> DataFrame:
    per = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.round(F.sum("o_totalprice"), 2).alias("revenue")
    )
    named = per.join(customer_regions(t).select("c_custkey", "region"), "c_custkey")
    return top_n(named, ["region"], [F.desc("revenue"), F.asc("c_custkey")], 3)


@query(
    "wn_04_running_total",
    """SELECT event_id, user_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
         ROWS UNBOUNDED PRECEDING), 2) AS running FROM events""",
)
def running_total(t: Tables) -> DataFrame:
    out = running_sums(
        timed_events(t), ["user_id"], ["ts", "event_id"], time_slice("sec", DAY), {"running": F.col("value")}
    )
    return out.select("event_id", "user_id", F.round("running", 2).alias("running"))


@query(
    "wn_05_rolling_average_8_days",
    f"""{_EV} SELECT event_id, user_id, round(avg(value) OVER w, 6)
          AS avg_7d FROM e WINDOW w AS (PARTITION BY user_id ORDER BY sec RANGE BETWEEN 604800 PRECEDING AND CURRENT ROW)""",
)
def rolling_average(t: Tables) -> DataFrame:
    """Seven times 86 400 seconds back, both ends in: the same second of day - 7 counts."""
    out = rolling_sums(timed_events(t), ["user_id"], "sec", time_slice("sec", DAY), "value", 7 * DAY, "w")
    return out.select("event_id", "user_id", F.round(F.col("w_sum") / F.col("w_n"), 6).alias("avg_7d"))


@query(
    "wn_06_rolling_revenue_7_days",
    """SELECT event_type, day, round(sum(value) OVER (PARTITION BY event_type ORDER BY day
         RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW), 2) AS rev_7d FROM
       (SELECT event_type, CAST(ts AS DATE) AS day, sum(value) AS value FROM events GROUP BY 1, 2)""",
)
def rolling_revenue(t: Tables) -> DataFrame:
    """Calendar days: the day itself and the six before it."""
    days = t.events.select("event_type", F.unix_date(F.to_date("ts")).cast("bigint").alias("d"), "value")
    out = rolling_totals(days, ["event_type"], "d", time_slice("d", 30), "value", 6, "rev")
    return out.select("event_type", F.date_from_unix_date(F.col("d").cast("int")).alias("day"), F.round("rev_sum", 2).alias("rev_7d"))


@query(
    "wn_07_spend_24h",
    f"""{_EV} SELECT event_id, user_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY sec
          RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW), 2) AS spend_24h FROM e""",
)
def spend_24h(t: Tables) -> DataFrame:
    out = rolling_sums(timed_events(t), ["user_id"], "sec", time_slice("sec", HOUR), "value", DAY, "spend")
    return out.select("event_id", "user_id", F.round("spend_sum", 2).alias("spend_24h"))


@query(
    "wn_08_moving_average_7_rows",
    """SELECT event_id, user_id, round(avg(value) OVER w, 6) AS avg_7
       FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
)
def moving_average_7(t: Tables) -> DataFrame:
    out = moving_average(
        timed_events(t), ["user_id"], ["ts", "event_id"], time_slice("sec", DAY), "value", 7, "avg_7"
    )
    return out.select("event_id", "user_id", F.round("avg_7", 6).alias("avg_7"))


@query(
    "wn_09_lag_lead_delta",
    """SELECT event_id, user_id, lag(value) OVER w AS prev, lead(value) OVER w AS next,
         round(value - lag(value) OVER w, 2) AS delta FROM events
       WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)
def lag_lead(t: Tables) -> DataFrame:
    order, slice_by = ["ts", "event_id"], time_slice("sec", DAY)
    before = neighbour(timed_events(t), ["user_id"], order, slice_by, {"prev": F.col("value")})
    both = neighbour(before, ["user_id"], order, slice_by, {"next": F.col("value")}, following=True)
    return both.select(
        "event_id", "user_id", "prev", "next", F.round(F.col("value") - F.col("prev"), 2).alias("delta")
    )


SESSION_SQL = f"""{_EV}, f AS (SELECT *, CASE WHEN sec - lag(sec) OVER w <= 1800 THEN 0 ELSE 1 END AS opens FROM e
  WINDOW w AS (PARTITION BY user_id ORDER BY sec, event_id)),
 s AS (SELECT event_id, user_id, sec, value, CAST(sum(opens) OVER (PARTITION BY user_id ORDER BY sec, event_id
  ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session_id FROM f)"""


@query("wn_10_sessions", f"{SESSION_SQL} SELECT event_id, user_id, session_id FROM s")
def session_ids(t: Tables) -> DataFrame:
    out = sessions(timed_events(t), ["user_id"], "sec", "event_id", time_slice("sec", DAY), 1800)
    return out.select("event_id", "user_id", "session_id")


@query(
    "wn_11_value_runs",
    """WITH f AS (SELECT event_id, user_id, ts, event_type, CASE WHEN event_type = lag(event_type) OVER
         (PARTITION BY user_id ORDER BY ts, event_id) THEN 0 ELSE 1 END AS opens FROM events)
       SELECT event_id, user_id, event_type, CAST(sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id
         ROWS UNBOUNDED PRECEDING) AS BIGINT) AS run_id FROM f""",
)
def value_runs(t: Tables) -> DataFrame:
    changed = F.col("_prev").isNull() | (F.col("_prev") != F.col("event_type"))
    out = runs(
        timed_events(t), ["user_id"], ["ts", "event_id"], time_slice("sec", DAY), F.col("event_type"), changed, "run_id"
    )
    return out.select("event_id", "user_id", "event_type", "run_id")


@query(
    "wn_12_grand_total",
    """WITH per AS (SELECT user_id, round(sum(value), 2) AS spent FROM events GROUP BY 1)
       SELECT user_id, spent, round(sum(spent) OVER (), 2) AS total, round(100.0e0 * spent / sum(spent) OVER (), 6) AS pct FROM per""",
)
def grand_total(t: Tables) -> DataFrame:
    per = t.events.groupBy("user_id").agg(F.round(F.sum("value"), 2).alias("spent"))
    total = per.agg(F.round(F.sum("spent"), 2).alias("t")).scalar()
    return (
        percent_of_total(per, "spent", "pct")
        .withColumn("total", total)
        .select("user_id", "spent", "total", F.round("pct", 6).alias("pct"))
    )


@query(
    "wn_13_week_over_week",
    """WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, sum(value) AS v FROM events GROUP BY 1, 2),
       r AS (SELECT user_id, day, round(sum(v) OVER (PARTITION BY user_id ORDER BY day RANGE BETWEEN INTERVAL 6 DAYS PRECEDING
           AND CURRENT ROW), 2) AS this_week, round(sum(v) OVER (PARTITION BY user_id ORDER BY day RANGE BETWEEN
           INTERVAL 13 DAYS PRECEDING AND INTERVAL 7 DAYS PRECEDING), 2) AS last_week FROM d)
       SELECT user_id, day, this_week, last_week FROM r WHERE this_week >= 2 * last_week""",
)
def week_over_week(t: Tables) -> DataFrame:
    """Days on which a user's spend of seven days is at least twice that of the seven before."""
    days = t.events.select("user_id", F.unix_date(F.to_date("ts")).cast("bigint").alias("d"), "value")
    week = rolling_totals(days, ["user_id"], "d", time_slice("d", 30), "value", 6, "short")
    fortnight = rolling_totals(days, ["user_id"], "d", time_slice("d", 30), "value", 13, "long")
    both = week.join(fortnight, ["user_id", "d"])
    # No event in the earlier week means no ratio, not a ratio to zero.
    earlier = F.when(
        F.col("long_n") > F.col("short_n"), F.round(F.col("long_sum") - F.col("short_sum"), 2)
    )
    return (
        both.select(
            "user_id",
            F.date_from_unix_date(F.col("d").cast("int")).alias("day"),
            F.round("short_sum", 2).alias("this_week"),
            earlier.alias("last_week"),
        )
        .where(F.col("this_week") >= 2 * F.col("last_week"))
    )


@query(
    "wn_14_rank_of_aggregate",
    """WITH per AS (SELECT c_mktsegment, round(sum(c_acctbal), 2) AS total FROM customer GROUP BY 1)
       SELECT c_mktsegment, total, CAST(rank() OVER (ORDER BY total DESC) AS INTEGER) AS place FROM per""",
)
def rank_of_aggregate(t: Tables) -> DataFrame:
    """One row per market segment remains, so a window without keys is harmless here."""
    per = t.customer.groupBy("c_mktsegment").agg(F.round(F.sum("c_acctbal"), 2).alias("total"))
    return per.withColumn("place", F.rank().over(Window.orderBy(F.desc("total"))))


# ---- the same work when one user has 40 % of all events: that user is cut into slices ----

_HOT = f"""WITH e AS (SELECT event_id, CASE WHEN event_id % 10 < 4 THEN 0 ELSE user_id END AS user_id, ts, value,
  {_SEC} AS sec FROM events)"""
_BUSY = 1_000


def hot_user_events(t: Tables) -> DataFrame:
    hot = F.pmod("event_id", F.lit(10)) < 4
    return timed_events(t).withColumn("user_id", F.when(hot, 0).otherwise(F.col("user_id")))


@query(
    "wn_04_running_total_skewed",
    f"""{_HOT} SELECT event_id, user_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
          ROWS UNBOUNDED PRECEDING), 2) AS running FROM e""",
)
def running_total_skewed(t: Tables) -> DataFrame:
    out = running_sums(
        hot_user_events(t),
        ["user_id"],
        ["ts", "event_id"],
        time_slice("sec", DAY),
        {"running": F.col("value")},
        hot_rows=_BUSY,
    )
    return out.select("event_id", "user_id", F.round("running", 2).alias("running"))


@query(
    "wn_07_spend_24h_skewed",
    f"""{_HOT} SELECT event_id, user_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY sec
          RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW), 2) AS spend_24h FROM e""",
)
def spend_24h_skewed(t: Tables) -> DataFrame:
    events = hot_user_events(t)
    out = rolling_sums(events, ["user_id"], "sec", time_slice("sec", HOUR), "value", DAY, "spend", _BUSY)
    return out.select("event_id", "user_id", F.round("spend_sum", 2).alias("spend_24h"))


@query(
    "wn_10_sessions_skewed",
    f"""{_HOT}, f AS (SELECT *, CASE WHEN sec - lag(sec) OVER w <= 600 THEN 0 ELSE 1 END AS opens FROM e
          WINDOW w AS (PARTITION BY user_id ORDER BY sec, event_id))
        SELECT event_id, user_id, CAST(sum(opens) OVER (PARTITION BY user_id ORDER BY sec, event_id
          ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session_id FROM f""",
)
def sessions_skewed(t: Tables) -> DataFrame:
    events = hot_user_events(t)
    out = sessions(events, ["user_id"], "sec", "event_id", time_slice("sec", DAY), 600, hot_rows=_BUSY)
    return out.select("event_id", "user_id", "session_id")
