"""Partitioning, skew reports, file layout, and the Python function surface."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewheel.operators import layout
from tidewheel.operators.enrich import enriched
from tidewheel.operators.skew import key_shares, partition_count, partition_rows
from tidewheel.plans.joins import SKEWED, skewed_lines
from tidewheel.plans.registry import Tables, query
from tidewheel.session import fresh_dir

_LINES = "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem"


def _lines(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query("pt_01_partition_rows")
def rows_per_partition(t: Tables) -> DataFrame:
    return partition_rows(t.lineitem)


@query("pt_02_partition_count")
def count_partitions(t: Tables) -> DataFrame:
    return partition_count(t.lineitem.repartition(6))


@query("pt_03_repartition", _LINES)
def repartition(t: Tables) -> DataFrame:
    return _lines(t).repartition(12, "l_partkey").repartition(6)


@query("pt_04_coalesce", _LINES)
def coalesce(t: Tables) -> DataFrame:
    return _lines(t).repartition(12).coalesce(4)


@query(
    "pt_05_hot_keys",
    f"""WITH {SKEWED} SELECT p_partkey, count(*) AS n_rows, count(*)::DOUBLE / (SELECT count(*) FROM skewed)::DOUBLE AS share
        FROM skewed GROUP BY 1""",
)
def hot_key_report(t: Tables) -> DataFrame:
    return key_shares(skewed_lines(t), ["p_partkey"])


@query(
    "pt_06_skew_choice",
    f"""WITH {SKEWED} SELECT p_type, sum(l_quantity) AS quantity FROM skewed JOIN part USING (p_partkey) GROUP BY 1""",
)
def skew_choice(t: Tables) -> DataFrame:
    """Adding up per key before the join leaves one row per key: nothing is skewed any more."""
    per_part = skewed_lines(t).groupBy("p_partkey").agg(F.sum("l_quantity").alias("q"))
    return (
        per_part.join(t.part.select("p_partkey", "p_type"), "p_partkey")
        .groupBy("p_type")
        .agg(F.sum("q").alias("quantity"))
    )


@query(
    "pt_07_two_forms",
    """SELECT 'early' AS form, count(*) AS n FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY o_orderpriority UNION ALL
       SELECT 'late', count(*) FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY o_orderpriority""",
)
def two_forms(t: Tables) -> DataFrame:
    """Filter before and after an aggregate on the filtered key; ``bench.py`` times such pairs."""
    urgent = F.col("o_orderpriority") == "1-URGENT"
    early = t.orders.where(urgent).groupBy("o_orderpriority").agg(F.count("*").alias("n"))
    late = t.orders.groupBy("o_orderpriority").agg(F.count("*").alias("n")).where(urgent)
    return early.select(F.lit("early").alias("form"), "n").unionByName(late.select(F.lit("late").alias("form"), "n"))


@query(
    "pt_08_columns",
    """SELECT 'o_orderkey' AS name, count(o_orderkey) AS filled FROM orders UNION ALL
       SELECT 'o_custkey', count(o_custkey) FROM orders UNION ALL SELECT 'o_orderstatus', count(o_orderstatus) FROM orders UNION ALL
       SELECT 'o_totalprice', count(o_totalprice) FROM orders UNION ALL SELECT 'o_orderdate', count(o_orderdate) FROM orders UNION ALL
       SELECT 'o_orderpriority', count(o_orderpriority) FROM orders""",
)
def columns(t: Tables) -> DataFrame:
    """Filled values of each column, the columns taken from the schema."""
    one = t.orders.agg(*[F.count(c).alias(c) for c in t.orders.columns])
    return one.unpivot([], t.orders.columns, "name", "filled")


def _fragments(t: Tables) -> str:
    path = fresh_dir(t.spark, "fragments")
    _lines(t).repartition(20).write.parquet(path)
    return path


@query("tbl_18_compacted", _LINES)
def compacted(t: Tables) -> DataFrame:
    source, target = _fragments(t), fresh_dir(t.spark, "compacted")
    layout.compact(t.spark, source, target)
    return t.spark.read.parquet(target)


@query("tbl_18_compacted_range", _LINES)
def compacted_range(t: Tables) -> DataFrame:
    source, target = _fragments(t), fresh_dir(t.spark, "compacted")
    layout.compact(t.spark, source, target, where=F.col("l_quantity") >= 40)
    return t.spark.read.parquet(target)


@query(
    "tbl_18_small_files_merged",
    "SELECT l_returnflag, l_orderkey, l_linenumber, l_quantity FROM lineitem",
)
def small_files_merged(t: Tables) -> DataFrame:
    """One partition comes in many small files, the others in one file each; only the former is merged."""
    path = fresh_dir(t.spark, "fragmented")
    rows = t.lineitem.select("l_returnflag", "l_orderkey", "l_linenumber", "l_quantity")
    small = F.col("l_returnflag") == "R"
    rows.where(small).repartition(12).write.partitionBy("l_returnflag").parquet(path)
    rows.where(~small).repartition("l_returnflag").write.mode("append").partitionBy("l_returnflag").parquet(path)
    layout.compact_small(t.spark, path, ["l_returnflag"])
    return t.spark.read.parquet(path)


def _clustered(t: Tables) -> DataFrame:
    path = fresh_dir(t.spark, "clustered")
    layout.clustered(
        _lines(t), ["l_partkey", "l_quantity"], ["l_orderkey", "l_linenumber"], 16
    ).write.parquet(path)
    return t.spark.read.parquet(path)


@query("tbl_19_clustered", _LINES)
def clustered(t: Tables) -> DataFrame:
    return _clustered(t)


@query("tbl_19_files_hit")
def files_hit(t: Tables) -> DataFrame:
    narrow = F.col("l_partkey").between(100, 150) & (F.col("l_quantity") > 45)
    return layout.files_hit(_clustered(t), narrow).select("n_rows")


@query(
    "tbl_20_file_rows",
    "SELECT 'lineitem' AS name, count(*) AS n_rows FROM lineitem UNION ALL SELECT 'orders', count(*) FROM orders",
)
def file_rows(t: Tables) -> DataFrame:
    parts = [
        layout.files(df).groupBy(F.lit(name).alias("name")).agg(F.sum("n_rows").alias("n_rows"))
        for name, df in (("lineitem", t.lineitem), ("orders", t.orders))
    ]
    return parts[0].unionByName(parts[1])


@query("tbl_20_file_detail")
def file_detail(t: Tables) -> DataFrame:
    return layout.file_detail(t.lineitem)


# ---- Python functions ----


@F.udf(T.StringType())
def _tidy(text):
    return text.strip().lower() if text is not None else None


@F.pandas_udf(T.StringType())
def _shout(text: pd.Series) -> pd.Series:
    return text.str.strip().str.upper()


@query("ud_01_python_udf", "SELECT doc_id, lower(trim(source)) AS source FROM documents")
def python_udf(t: Tables) -> DataFrame:
    """The slow form, kept to show that the built-in gives the same."""
    return t.documents.select("doc_id", _tidy("source").alias("source"))


@query("ud_02_pandas_udf", "SELECT doc_id, upper(trim(source)) AS source FROM documents")
def pandas_udf(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", _shout("source").alias("source"))


def flaky_client():
    """A stand-in for a service: the call for key k fails ``k % 5`` times before it answers."""
    failures: dict[int, int] = {}

    def call(key: int) -> str:
        failures[key] = failures.get(key, 0) + 1
        if failures[key] <= key % 5:
            raise ConnectionError("busy")
        return f"user_{key}"

    return call


@query(
    "ud_04_enrichment",
    """SELECT c_custkey AS id, CASE WHEN c_custkey % 5 < 3 THEN 'user_' || c_custkey END AS result,
         CAST(least(c_custkey % 5 + 1, 3) AS INTEGER) AS attempts,
         CASE WHEN c_custkey % 5 >= 3 THEN 'ConnectionError: busy' END AS error FROM customer""",
)
def enrichment(t: Tables) -> DataFrame:
    return enriched(
        t.customer, "c_custkey", flaky_client, attempts=3, base=0.0, jitter=0.0, retry_on=(ConnectionError,)
    )
