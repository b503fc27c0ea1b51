"""Upserts, histories and incremental loads over batches derived from the tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.operators import history as scd
from tidewheel.operators import incremental as inc
from tidewheel.operators.upserts import (
    after_images,
    apply_changes,
    change_feed,
    insert_new,
    update_where,
    upsert,
    upsert_partitions,
)
from tidewheel.plans.registry import Tables, query
from tidewheel.session import fresh_dir
from tidewheel.sources.sinks import create_database, materialised, write_partitioned

# The target holds the orders up to 1999; the batch holds the later orders as new rows, and the
# finished orders of the target again with another status and price.
_SPLIT = "TIMESTAMP '1999-01-01'"
_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice"
_TB = f"""WITH tgt AS (SELECT {_COLS} FROM orders WHERE o_orderdate < {_SPLIT}),
  src AS (SELECT o_orderkey, o_custkey, 'X' AS o_orderstatus, o_totalprice + 1 AS o_totalprice FROM orders
          WHERE o_orderdate >= {_SPLIT} OR o_orderstatus = 'F')"""


def _early() -> Column:
    return F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz")


def target_orders(t: Tables) -> DataFrame:
    return t.orders.where(_early()).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


def batch_orders(t: Tables) -> DataFrame:
    again = F.col("o_orderstatus") == "F"
    return t.orders.where(~_early() | again).select(
        "o_orderkey", "o_custkey", F.lit("X").alias("o_orderstatus"), (F.col("o_totalprice") + 1).alias("o_totalprice")
    )


@query(
    "tbl_01_upsert",
    f"""{_TB} SELECT * FROM src UNION ALL SELECT * FROM tgt WHERE o_orderkey NOT IN (SELECT o_orderkey FROM src)""",
)
def plain_upsert(t: Tables) -> DataFrame:
    return upsert(target_orders(t), batch_orders(t), ["o_orderkey"])


@query(
    "tbl_01_upsert_twice",
    f"""{_TB} SELECT * FROM src UNION ALL SELECT * FROM tgt WHERE o_orderkey NOT IN (SELECT o_orderkey FROM src)""",
)
def upsert_twice(t: Tables) -> DataFrame:
    """The same batch again changes nothing."""
    once = upsert(target_orders(t), batch_orders(t), ["o_orderkey"])
    return upsert(once, batch_orders(t), ["o_orderkey"])


@query(
    "tbl_02_upsert_columns",
    f"""{_TB} SELECT t.o_orderkey, t.o_custkey, coalesce(s.o_orderstatus, t.o_orderstatus) AS o_orderstatus,
          CASE WHEN s.o_orderkey IS NULL THEN t.o_totalprice ELSE t.o_totalprice + s.o_totalprice END AS o_totalprice
        FROM tgt t LEFT JOIN src s USING (o_orderkey)""",
)
def upsert_columns(t: Tables) -> DataFrame:
    changes = {
        "o_orderstatus": F.col("s.o_orderstatus"),
        "o_totalprice": F.col("t.o_totalprice") + F.col("s.o_totalprice"),
    }
    return upsert(target_orders(t), batch_orders(t), ["o_orderkey"], update=changes, insert=False)


@query(
    "tbl_03_insert_only",
    f"""{_TB} SELECT * FROM tgt UNION ALL SELECT * FROM src WHERE o_orderkey NOT IN (SELECT o_orderkey FROM tgt)""",
)
def insert_only(t: Tables) -> DataFrame:
    return insert_new(target_orders(t), batch_orders(t), ["o_orderkey"])


@query(
    "tbl_04_merge_delete",
    f"""{_TB} SELECT * FROM src WHERE NOT (o_totalprice > 300000 AND o_orderkey IN (SELECT o_orderkey FROM tgt))
        UNION ALL SELECT * FROM tgt WHERE o_orderkey NOT IN (SELECT o_orderkey FROM src)""",
)
def merge_delete(t: Tables) -> DataFrame:
    return upsert(
        target_orders(t), batch_orders(t), ["o_orderkey"], delete_when=F.col("s.o_totalprice") > 300000
    )


@query(
    "tbl_05_partition_merge",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
         CAST(CASE WHEN o_orderstatus = 'F' AND year(o_orderdate) < 1997 THEN 1997 ELSE year(o_orderdate) END AS INTEGER) AS y
       FROM orders""",
)
def partition_merge(t: Tables) -> DataFrame:
    """Finished orders change; those from before 1997 also move to another partition."""
    create_database(t.spark, "tidewheel_db")
    path = fresh_dir(t.spark, "merge-table")
    dated = t.orders.select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("y"))
    write_partitioned(dated, path, ["y"])
    name = "tidewheel_db.orders_by_year"
    t.spark.sql(f"DROP TABLE IF EXISTS {name}")
    t.spark.sql(
        f"CREATE TABLE {name} (o_orderkey BIGINT, o_totalprice DOUBLE, y INT) USING parquet PARTITIONED BY (y) LOCATION '{path}'"
    )
    t.spark.sql(f"MSCK REPAIR TABLE {name}")
    batch = t.orders.where(F.col("o_orderstatus") == "F").select(
        "o_orderkey",
        (F.col("o_totalprice") + 1).alias("o_totalprice"),
        F.greatest(F.year("o_orderdate"), F.lit(1997)).alias("y"),
    )
    upsert_partitions(t.spark, name, batch, ["o_orderkey"], "y")
    return t.spark.table(name)


@query(
    "tbl_06_deduplicated_batch",
    """WITH s AS (SELECT user_id, event_id, ts, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id
         ORDER BY ts DESC, event_id DESC) AS rn FROM events WHERE event_type = 'purchase') WHERE rn = 1),
       c AS (SELECT c_custkey AS user_id, CAST(-1 AS BIGINT) AS event_id, TIMESTAMP '2024-01-01' AS ts, c_acctbal AS value FROM customer)
       SELECT * FROM s UNION ALL SELECT * FROM c WHERE user_id NOT IN (SELECT user_id FROM s)""",
)
def deduplicated_batch(t: Tables) -> DataFrame:
    accounts = t.customer.select(
        F.col("c_custkey").alias("user_id"),
        F.lit(-1).cast("bigint").alias("event_id"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("ts"),
        F.col("c_acctbal").alias("value"),
    )
    batch = t.events.where(F.col("event_type") == "purchase").select("user_id", "event_id", "ts", "value")
    return upsert(accounts, batch, ["user_id"], newest=("ts", "event_id"))


def _account_events(t: Tables) -> DataFrame:
    """Account changes: an error deletes, a signup inserts, everything else updates."""
    op = F.when(F.col("event_type") == "error", "D").when(F.col("event_type") == "signup", "I").otherwise("U")
    return t.events.select("user_id", "value", op.alias("op"), "ts", "event_id")


_CDC_SQL = """WITH l AS (SELECT user_id, value, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id
    ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1)
  SELECT user_id, value FROM l WHERE event_type <> 'error' UNION ALL
  SELECT c_custkey, c_acctbal FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM l)"""


def _accounts(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_custkey").alias("user_id"), F.col("c_acctbal").alias("value"))


@query("tbl_07_change_events", _CDC_SQL)
def change_events(t: Tables) -> DataFrame:
    return apply_changes(_accounts(t), _account_events(t), ["user_id"], "ts", "event_id")


@query("tbl_07_row_images", _CDC_SQL)
def row_images(t: Tables) -> DataFrame:
    """The same changes as a log with before and after images."""
    image = F.struct("user_id", "value")
    gone = F.col("op") == "D"
    log = _account_events(t).select(
        F.when(gone, image).alias("before"), F.when(~gone, image).alias("after"), "op", "ts", "event_id"
    )
    changes = after_images(log, "after", "op", "ts", "event_id", ["user_id"], "before")
    return apply_changes(_accounts(t), changes, ["user_id"], "ts", "event_id")


@query(
    "tbl_07_snapshots",
    f"""{_TB} SELECT * FROM src UNION ALL SELECT * FROM tgt WHERE o_orderkey NOT IN (SELECT o_orderkey FROM src)""",
)
def snapshot_merge(t: Tables) -> DataFrame:
    """A periodic full dump is merged on the natural key, in the order of the dumps."""
    dumps = [batch_orders(t).withColumn("o_totalprice", F.col("o_totalprice") * 2), batch_orders(t)]
    state = target_orders(t)
    for dump in dumps:
        state = materialised(upsert(state, dump, ["o_orderkey"]), "snapshot")
    return state


@query(
    "tbl_08_conditional_update",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN o_totalprice * 1.1e0 ELSE o_totalprice END AS o_totalprice FROM orders""",
)
def conditional_update(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    changed = update_where(orders, F.col("o_orderstatus") == "P", {"o_totalprice": F.col("o_totalprice") * 1.1})
    return changed.select("o_orderkey", "o_totalprice")


@query(
    "tbl_10_change_feed",
    f"""{_TB} SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey, coalesce(s.o_orderstatus, t.o_orderstatus) AS o_orderstatus,
          CASE WHEN t.o_orderkey IS NULL THEN 'insert' WHEN s.o_orderkey IS NULL THEN 'delete' ELSE 'update' END AS change_type
        FROM tgt t FULL JOIN src s ON t.o_orderkey = s.o_orderkey""",
)
def feed(t: Tables) -> DataFrame:
    two = ["o_orderkey", "o_orderstatus"]
    return change_feed(target_orders(t).select(*two), batch_orders(t).select(*two), ["o_orderkey"])


@query(
    "tbl_11_scd0",
    f"""{_TB} SELECT * FROM tgt UNION ALL SELECT * FROM src WHERE o_orderkey NOT IN (SELECT o_orderkey FROM tgt)""",
)
def scd0(t: Tables) -> DataFrame:
    return scd.keep_first(target_orders(t), batch_orders(t), ["o_orderkey"])


@query(
    "tbl_11_scd1",
    f"""{_TB} SELECT * FROM src UNION ALL SELECT * FROM tgt WHERE o_orderkey NOT IN (SELECT o_orderkey FROM src)""",
)
def scd1(t: Tables) -> DataFrame:
    return scd.overwrite(target_orders(t), batch_orders(t), ["o_orderkey"])


@query(
    "tbl_11_scd3",
    f"""{_TB} SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey, coalesce(s.o_orderstatus, t.o_orderstatus) AS o_orderstatus,
          CASE WHEN s.o_orderkey IS NOT NULL AND t.o_orderkey IS NOT NULL THEN t.o_orderstatus END AS previous_status
        FROM tgt t FULL JOIN src s ON t.o_orderkey = s.o_orderkey""",
)
def scd3(t: Tables) -> DataFrame:
    target = target_orders(t).select("o_orderkey", "o_orderstatus", F.lit(None).cast("string").alias("previous_status"))
    batch = batch_orders(t).select("o_orderkey", "o_orderstatus")
    return scd.keep_previous(target, batch, ["o_orderkey"], "o_orderstatus", "previous_status")


# ---- SCD2: customers of the first nations have a history; a batch of low balances moves some of
# them to another segment (or none), repeats others unchanged and brings customers of new nations ----


def _history(t: Tables) -> DataFrame:
    return t.customer.where(F.col("c_nationkey") < 20).select(
        "c_custkey",
        "c_name",
        "c_mktsegment",
        F.lit("2024-01-01").cast("date").alias("effective_from"),
        F.lit(None).cast("date").alias("effective_to"),
        F.lit(True).alias("is_current"),
    )


def _moves(t: Tables) -> DataFrame:
    balance = F.col("c_acctbal")
    segment = F.when(balance < 0, None).when(balance < 1500, "SPECIAL").otherwise(F.col("c_mktsegment"))
    return t.customer.where(balance < 3000).select(
        "c_custkey", "c_name", segment.alias("c_mktsegment"), F.lit("2024-06-09").cast("date").alias("effective_from")
    )


_SCD2_SQL = """WITH h AS (SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_nationkey < 20),
  b AS (SELECT c_custkey, c_name, CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal < 1500 THEN 'SPECIAL' ELSE c_mktsegment END
        AS c_mktsegment FROM customer WHERE c_acctbal < 3000),
  ch AS (SELECT b.* FROM b JOIN h USING (c_custkey) WHERE b.c_mktsegment IS DISTINCT FROM h.c_mktsegment),
  full_history AS (
  SELECT *, DATE '2024-01-01' AS effective_from, CASE WHEN c_custkey IN (SELECT c_custkey FROM ch) THEN DATE '2024-06-09' END
    AS effective_to, c_custkey NOT IN (SELECT c_custkey FROM ch) AS is_current FROM h
  UNION ALL SELECT *, DATE '2024-06-09', NULL, TRUE FROM ch
  UNION ALL SELECT *, DATE '2024-06-09', NULL, TRUE FROM b WHERE c_custkey NOT IN (SELECT c_custkey FROM h))"""
_TRACKED = ["c_name", "c_mktsegment"]


@query("tbl_12_scd2_load", f"{_SCD2_SQL} SELECT * FROM full_history")
def scd2(t: Tables) -> DataFrame:
    return scd.load_history(_history(t), _moves(t), ["c_custkey"], _TRACKED)


@query("rp_10_history_load_twice", f"{_SCD2_SQL} SELECT * FROM full_history")
def scd2_twice(t: Tables) -> DataFrame:
    """Loading the batch again adds no version."""
    once = materialised(scd.load_history(_history(t), _moves(t), ["c_custkey"], _TRACKED), "scd2")
    return scd.load_history(once, _moves(t), ["c_custkey"], _TRACKED)


@query(
    "tbl_13_as_of",
    f"""{_SCD2_SQL} SELECT c_custkey, c_mktsegment FROM full_history WHERE effective_from <= DATE '2024-03-05'
        AND (effective_to IS NULL OR DATE '2024-03-05' < effective_to)""",
)
def as_of(t: Tables) -> DataFrame:
    table = scd.load_history(_history(t), _moves(t), ["c_custkey"], _TRACKED)
    return scd.as_of(table, F.lit("2024-03-05").cast("date")).select("c_custkey", "c_mktsegment")


# ---- incremental ----

_MARK = dt.datetime(2024, 1, 20)


@query(
    "tbl_14_high_water_mark",
    """SELECT event_id, user_id, value, ts FROM events""",
)
def high_water_mark(t: Tables) -> DataFrame:
    """First load without a mark, then a load from the stored mark; together all events, once."""
    root = fresh_dir(t.spark, "marks")
    events = t.events.select("event_id", "user_id", "value", "ts")
    first = events.where(F.col("ts") <= F.lit(_MARK).cast("timestamp_ntz"))
    silver = materialised(inc.since(first, "ts", None), "silver")
    inc.save_mark(t.spark, f"{root}/marks", "events", inc.next_mark(silver, "ts"))
    fresh = inc.since(events, "ts", inc.read_mark(t.spark, f"{root}/marks", "events"))
    return upsert(silver, fresh, ["event_id"])


def raw_events(t: Tables) -> DataFrame:
    """Events as an outside source would send them: text columns, and dirty and repeated rows."""
    value, kind = F.col("value"), F.col("event_type")
    text = value.cast("string")
    amount = F.when(value > 150, F.concat(F.lit("-"), text)).when(value < 1, "n/a").otherwise(text)
    status = (
        F.when(kind == "view", F.upper(kind))
        .when(value.between(40, 42), "")
        .otherwise(F.concat(F.lit(" "), kind))
    )
    sent = t.events.select(
        F.col("event_id").cast("string").alias("row_id"),
        F.col("user_id").cast("string").alias("user_id"),
        amount.alias("amount"),
        status.alias("status"),
        F.col("ts").cast("string").alias("ts"),
    )
    return sent.unionByName(sent.where(F.col("status") == " click"))


_STATUSES = ["click", "view", "purchase", "signup"]
_SILVER_SQL = """WITH silver AS (SELECT event_id AS row_id, user_id, value AS amount, event_type AS status, ts FROM events
  WHERE value BETWEEN 1 AND 150 AND (event_type = 'view' OR value NOT BETWEEN 40 AND 42) AND event_type <> 'error')"""


@query("tbl_15_silver", f"{_SILVER_SQL} SELECT * FROM silver")
def silver(t: Tables) -> DataFrame:
    return inc.to_silver(raw_events(t), _STATUSES)


_GOLD = """ SELECT CAST(ts AS DATE) AS day, status, round(sum(amount), 2) AS revenue, count(*) AS n_orders,
  round(avg(amount), 4) AS avg_amount FROM silver GROUP BY 1, 2"""


@query("tbl_16_gold", _SILVER_SQL + _GOLD)
def gold(t: Tables) -> DataFrame:
    return inc.to_gold(inc.to_silver(raw_events(t), _STATUSES))


@query("rp_7_medallion", _SILVER_SQL + _GOLD)
def medallion(t: Tables) -> DataFrame:
    """Each layer is a table of its own, so that silver can be rebuilt from raw rows."""
    bronze = materialised(raw_events(t), "bronze")
    clean = materialised(inc.to_silver(bronze, _STATUSES), "silver")
    return inc.to_gold(clean)


_SPEND_SQL = """WITH e AS (SELECT event_id, user_id, ts, value, CAST(floor(epoch(ts)) AS BIGINT) AS sec FROM events),
  w AS (SELECT event_id, user_id, ts, value, round(sum(value) OVER (PARTITION BY user_id ORDER BY sec RANGE BETWEEN 86400 PRECEDING
    AND CURRENT ROW), 2) AS spend FROM e)"""


@query("tbl_17_incremental_spend", f"{_SPEND_SQL} SELECT * FROM w WHERE ts > TIMESTAMP '2024-01-20'")
def incremental_spend(t: Tables) -> DataFrame:
    events = t.events.select("event_id", "user_id", "ts", "value")
    return inc.spend_of_new(events, "user_id", "ts", "value", _MARK)


@query("rp_4_spend_24h", f"{_SPEND_SQL} SELECT * FROM w")
def spend_load(t: Tables) -> DataFrame:
    """First load, then an hourly-style load of the new rows: their union is the full recompute."""
    events = t.events.select("event_id", "user_id", "ts", "value")
    old = events.where(F.col("ts") <= F.lit(_MARK).cast("timestamp_ntz"))
    silver_0 = materialised(old, "silver")
    first = materialised(inc.spend_of_new(silver_0, "user_id", "ts", "value", None), "gold")
    mark = inc.next_mark(silver_0, "ts")
    silver_1 = materialised(insert_new(silver_0, inc.since(events, "ts", mark), ["event_id"]), "silver")
    return first.unionByName(inc.spend_of_new(silver_1, "user_id", "ts", "value", mark))
