"""Sources and sinks: what is written must read back as the same rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.plans.registry import Tables, query
from tidewheel.session import fresh_dir
from tidewheel.sources import snapshots
from tidewheel.sources.landing import land, log_schema, read_landed
from tidewheel.sources.readers import generated, new_files, read_files
from tidewheel.sources.sinks import (
    append_checked,
    append_evolving,
    append_files,
    create_database,
    create_table,
    cut_lineage,
    materialised,
    read_evolved,
    replace_slices,
    right_sized,
    run_only,
    save_table,
    write_partitioned,
)
from tidewheel.streaming.jobs import ingest_files

_ORDERS = "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders"
_ORDER_DDL = "o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE, o_orderpriority STRING"


def plain_orders(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")


@query(
    "src_01_generated",
    """WITH g AS (SELECT CAST(unnest(range((SELECT count(*) FROM lineitem))) AS BIGINT) AS id),
       o AS (SELECT id, id % 2000 AS product_id, CASE WHEN id % 10 < 4 THEN 0 ELSE id % 1500 END AS customer_id,
              id % 5 + 1 AS qty FROM g)
       SELECT customer_id, count(*) AS n, CAST(sum(qty) AS BIGINT) AS qty, count(DISTINCT product_id) AS products
       FROM o GROUP BY 1""",
)
def generated_orders(t: Tables) -> DataFrame:
    """As many generated orders as there are lines, 40 % of them of one customer."""
    i = F.col("id")
    orders = generated(
        t.spark,
        t.lineitem.count(),
        {
            "product_id": i % 2000,
            "customer_id": F.when(i % 10 < 4, 0).otherwise(i % 1500),
            "qty": i % 5 + 1,
            "discount": F.rand(3),
        },
    )
    return orders.groupBy("customer_id").agg(
        F.count("*").alias("n"), F.sum("qty").alias("qty"), F.count_distinct("product_id").alias("products")
    )


@query(
    "src_03_table",
    "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1",
)
def managed_table(t: Tables) -> DataFrame:
    create_database(t.spark, "tidewheel_db")
    save_table(plain_orders(t), "tidewheel_db.orders_read")
    return t.spark.table("tidewheel_db.orders_read").groupBy("o_orderpriority").agg(F.count("*").alias("n"))


def _round_trip(t: Tables, fmt: str, **options) -> DataFrame:
    path = fresh_dir(t.spark, fmt)
    plain_orders(t).write.format(fmt).options(**options).save(path)
    return read_files(t.spark, path, fmt, _ORDER_DDL, **options)


@query("src_04_csv", _ORDERS)
def csv(t: Tables) -> DataFrame:
    return _round_trip(t, "csv", header=True)


@query("src_04_json", _ORDERS)
def json(t: Tables) -> DataFrame:
    return _round_trip(t, "json")


@query("src_04_parquet", _ORDERS)
def parquet(t: Tables) -> DataFrame:
    return _round_trip(t, "parquet")


@query(
    "src_04_csv_inferred",
    "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders",
)
def csv_inferred(t: Tables) -> DataFrame:
    path = fresh_dir(t.spark, "csv")
    plain_orders(t).write.option("header", True).csv(path)
    read = read_files(t.spark, path, "csv", header=True)
    keys = [F.col(c).cast("bigint") for c in ("o_orderkey", "o_custkey")]  # inferred as INT or BIGINT by their size
    return read.select(*keys, "o_totalprice", "o_orderpriority")


@query(
    "src_07_schema_log",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 2 THEN NULL ELSE o_totalprice END AS o_totalprice,
       CASE WHEN o_orderkey % 3 > 0 THEN o_orderpriority END AS o_orderpriority,
       CASE WHEN o_orderkey % 3 = 2 THEN 'about ' || CAST(floor(o_totalprice) AS BIGINT) END AS price_text FROM orders""",
)
def schema_log(t: Tables) -> DataFrame:
    """The second delivery brings a new field, the third a price that is no number; no value is lost."""
    root = fresh_dir(t.spark, "schema-log")
    log_schema(t.spark, root, 0, {"o_orderkey": "bigint", "o_totalprice": "double"})
    about = F.concat(F.lit("about "), F.floor("o_totalprice").cast("string"))
    deliveries = [["o_totalprice"], ["o_totalprice", "o_orderpriority"], [about.alias("o_totalprice"), "o_orderpriority"]]
    for k, columns in enumerate(deliveries):
        t.orders.where(F.col("o_orderkey") % 3 == k).select("o_orderkey", *columns).write.mode("append").json(f"{root}/inbox")
        land(t.spark, f"{root}/inbox", root)
    return read_landed(t.spark, root).select(
        "o_orderkey", "o_totalprice", "o_orderpriority", F.col("_rescued")["o_totalprice"].alias("price_text")
    )

@query("src_05_declared_schema", "SELECT o_orderkey, o_totalprice FROM orders")
def declared_schema(t: Tables) -> DataFrame:
    return read_files(t.spark, f"{t.base}/orders.parquet", "parquet", "o_orderkey BIGINT, o_totalprice DOUBLE")


@query(
    "src_06_inline_values",
    """WITH names AS (SELECT * FROM (VALUES ('O', 'open'), ('F', 'filled'), ('P', 'partial')) AS v(code, label))
       SELECT label, count(*) AS n FROM orders JOIN names ON o_orderstatus = code GROUP BY 1""",
)
def inline_values(t: Tables) -> DataFrame:
    t.orders.createOrReplaceTempView("tidewheel_orders")
    return t.spark.sql(
        """WITH names AS (SELECT * FROM VALUES ('O', 'open'), ('F', 'filled'), ('P', 'partial') AS v(code, label))
           SELECT label, count(*) AS n FROM tidewheel_orders JOIN names ON o_orderstatus = code GROUP BY label"""
    )


@query("src_07_new_files", _ORDERS)
def only_new_files(t: Tables) -> DataFrame:
    """Two deliveries, two runs, one checkpoint: every row lands once."""
    root = fresh_dir(t.spark, "ingest")
    orders = plain_orders(t)
    large = F.col("o_totalprice") > 200000
    for delivery in (orders.where(large), orders.where(~large)):
        append_files(delivery, f"{root}/inbox")
        source = new_files(t.spark, f"{root}/inbox", _ORDER_DDL)
        ingest_files(t.spark, source, f"{root}/landed", f"{root}/checkpoint")
    return t.spark.read.schema(_ORDER_DDL).parquet(f"{root}/landed")


@query("snk_01_overwrite_table", _ORDERS)
def overwrite_table(t: Tables) -> DataFrame:
    create_database(t.spark, "tidewheel_db")
    save_table(plain_orders(t).limit(0), "tidewheel_db.orders_out")
    save_table(plain_orders(t), "tidewheel_db.orders_out")
    return t.spark.table("tidewheel_db.orders_out")


@query("snk_02_append", _ORDERS)
def append(t: Tables) -> DataFrame:
    path = fresh_dir(t.spark, "append")
    big = F.col("o_totalprice") > 200000
    append_files(plain_orders(t).where(big), path)
    append_files(plain_orders(t).where(~big), path)
    return t.spark.read.schema(_ORDER_DDL).parquet(path)


@query(
    "snk_03_partitioned",
    """SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders
       WHERE year(o_orderdate) IN (1996, 1999)""",
)
def partitioned(t: Tables) -> DataFrame:
    path = fresh_dir(t.spark, "partitioned")
    dated = t.orders.select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"))
    write_partitioned(dated, path, ["year"])
    return t.spark.read.parquet(path).where(F.col("year").isin(1996, 1999))


@query("snk_04_noop", "SELECT count(*) AS n_lines FROM lineitem")
def noop(t: Tables) -> DataFrame:
    run_only(t.lineitem.select((F.col("l_quantity") * F.col("l_extendedprice")).alias("x")))
    return t.lineitem.agg(F.count("*").alias("n_lines"))


@query("snk_05_temp_view", "SELECT o_orderpriority, max(o_totalprice) AS top FROM orders GROUP BY 1")
def temp_view(t: Tables) -> DataFrame:
    plain_orders(t).createOrReplaceTempView("tidewheel_view")
    return t.spark.sql("SELECT o_orderpriority, max(o_totalprice) AS top FROM tidewheel_view GROUP BY 1")


@query(
    "snk_06_insert_values",
    "SELECT 'orders' AS source, max(o_orderdate) AS mark FROM orders",
)
def insert_values(t: Tables) -> DataFrame:
    path = fresh_dir(t.spark, "marks")
    append_files(t.orders.agg(F.lit("orders").alias("source"), F.max("o_orderdate").alias("mark")), path)
    return t.spark.read.parquet(path)


@query(
    "snk_07_replaced_slice",
    """SELECT o_orderkey, CASE WHEN year(o_orderdate) = 1997 THEN 0.0 ELSE o_totalprice END AS o_totalprice,
         CAST(year(o_orderdate) AS INTEGER) AS year FROM orders""",
)
def replaced_slice(t: Tables) -> DataFrame:
    path = fresh_dir(t.spark, "slices")
    dated = t.orders.select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"))
    write_partitioned(dated, path, ["year"])
    replace_slices(dated.where("year = 1997").withColumn("o_totalprice", F.lit(0.0)), path, ["year"])
    return t.spark.read.parquet(path)


@query(
    "snk_08_new_column",
    """SELECT o_orderkey, o_totalprice, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS o_orderpriority
       FROM orders""",
)
def new_column(t: Tables) -> DataFrame:
    path = fresh_dir(t.spark, "evolving")
    done = F.col("o_orderstatus") == "F"
    append_files(t.orders.where(~done).select("o_orderkey", "o_totalprice"), path)
    append_evolving(t.orders.where(done).select("o_orderkey", "o_totalprice", "o_orderpriority"), path)
    return read_evolved(t.spark, path).select("o_orderkey", "o_totalprice", "o_orderpriority")


@query("snk_09_checked_append", _ORDERS)
def checked_append(t: Tables) -> DataFrame:
    path = fresh_dir(t.spark, "checked")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    append_files(plain_orders(t).where(urgent), path)
    append_checked(plain_orders(t).where(~urgent), path)
    return t.spark.read.parquet(path)


@query("snk_10_right_sized", _ORDERS)
def right_size(t: Tables) -> DataFrame:
    path = fresh_dir(t.spark, "sized")
    right_sized(plain_orders(t)).write.parquet(path)
    return t.spark.read.parquet(path)


@query(
    "snk_11_materialised",
    """SELECT count(*) AS n_orders, count(*) FILTER (o_totalprice * 1.2e0 > 300000) AS n_large,
         round(sum(o_totalprice * 1.2e0), 2) AS taxed_total FROM orders""",
)
def reused_table(t: Tables) -> DataFrame:
    taxed = materialised(t.orders.select((F.col("o_totalprice") * 1.2).alias("taxed")), "taxed")
    return taxed.agg(
        F.count("*").alias("n_orders"),
        F.count_if(F.col("taxed") > 300000).alias("n_large"),
        F.round(F.sum("taxed"), 2).alias("taxed_total"),
    )


@query("snk_12_checkpoint", "SELECT o_custkey, count(*) AS n, max(o_totalprice) AS top FROM orders GROUP BY 1")
def checkpoint(t: Tables) -> DataFrame:
    per = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"), F.max("o_totalprice").alias("top"))
    return cut_lineage(per)


@query("snk_13_ddl", _ORDERS)
def ddl(t: Tables) -> DataFrame:
    create_database(t.spark, "tidewheel_db")
    create_table(t.spark, "tidewheel_db.orders_ddl", _ORDER_DDL)
    plain_orders(t).write.insertInto("tidewheel_db.orders_ddl")
    return t.spark.table("tidewheel_db.orders_ddl")


# ---- versions (TBL-9, TBL-21, SRC-8) ----

_DAY = dt.timedelta(days=1)
_T0 = dt.datetime(2024, 1, 1)


def _three_versions(t: Tables) -> str:
    root = fresh_dir(t.spark, "versions")
    orders = plain_orders(t)
    raised = orders.withColumn("o_totalprice", F.col("o_totalprice") * 2)
    snapshots.write_version(orders, root, 0, "load", _T0)
    snapshots.write_version(raised, root, 1, "update", _T0 + _DAY)
    snapshots.restore(t.spark, root, 0, _T0 + 2 * _DAY)
    return root


@query("src_08_version_as_of", "SELECT o_orderkey, o_custkey, o_totalprice * 2 AS o_totalprice, o_orderpriority FROM orders")
def version_as_of(t: Tables) -> DataFrame:
    return snapshots.read_version(t.spark, _three_versions(t), 1)


@query("src_08_timestamp_as_of", _ORDERS)
def timestamp_as_of(t: Tables) -> DataFrame:
    return snapshots.read_as_of(t.spark, _three_versions(t), _T0 + dt.timedelta(hours=5))


@query("tbl_09_restore", _ORDERS)
def restored(t: Tables) -> DataFrame:
    root = _three_versions(t)
    return snapshots.read_version(t.spark, root, snapshots.latest_version(t.spark, root))


@query(
    "tbl_09_history",
    """SELECT version, committed_at, operation, (SELECT count(*) FROM orders) AS n_rows FROM (VALUES
         (0, TIMESTAMP '2024-01-01', 'load'), (1, TIMESTAMP '2024-01-02', 'update'),
         (2, TIMESTAMP '2024-01-03', 'restore 0')) AS v(version, committed_at, operation)""",
)
def history(t: Tables) -> DataFrame:
    root = _three_versions(t)
    every = t.spark.read.option("basePath", root).parquet(f"{root}/v=*")
    sizes = every.groupBy(F.col("v").alias("version")).agg(F.count("*").alias("n_rows"))
    return snapshots.versions(t.spark, root).join(sizes, "version")


@query(
    "tbl_21_expired",
    """SELECT 0 AS version, TIMESTAMP '2024-01-01' AS committed_at, TIMESTAMP '2024-01-02' AS replaced_at
       WHERE (SELECT count(*) FROM orders) > 0""",
)
def expired(t: Tables) -> DataFrame:
    root = _three_versions(t)
    return snapshots.expired_versions(t.spark, root, _T0 + 9 * _DAY, 7 * _DAY + _DAY / 2)
