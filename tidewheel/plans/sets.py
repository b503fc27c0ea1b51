"""Sorts, limits, set operations and deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.functions.text import squeezed, text_key
from tidewheel.operators.dedup import drop_copies, smallest_id, union_all
from tidewheel.operators.similar import drop_similar, similar_groups
from tidewheel.operators.windows import latest
from tidewheel.plans.registry import Tables, query


@query("so_01_order_by", "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders ORDER BY 2, 3 DESC, 1")
def order_by(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice").orderBy(
        "o_orderpriority", F.desc("o_totalprice"), "o_orderkey"
    )


@query("so_02_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def top_k(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)


@query("so_03_peek")
def peek(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_quantity").limit(20)


@query(
    "so_04_small_result",
    "SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3",
)
def small_result(t: Tables) -> DataFrame:
    """Aggregated and limited first, so that a caller may collect it."""
    return t.customer.groupBy("c_mktsegment").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "c_mktsegment").limit(3)


@query("so_05_unsorted", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1")
def unsorted(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"))


@query(
    "st_01_union_all",
    """SELECT c_name AS name, c_acctbal AS balance FROM customer UNION ALL SELECT s_name, s_acctbal FROM supplier""",
)
def union_two(t: Tables) -> DataFrame:
    customers = t.customer.select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    suppliers = t.supplier.select(F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"))
    return customers.unionByName(suppliers)


@query(
    "st_02_union_many",
    " UNION ALL ".join(
        f"SELECT '{k}' AS kind, event_id, value FROM events WHERE event_type = '{k}'"
        for k in ("click", "view", "purchase", "signup", "error")
    ),
)
def union_many(t: Tables) -> DataFrame:
    kinds = ("click", "view", "purchase", "signup", "error")
    return union_all(
        [t.events.where(F.col("event_type") == k).select(F.lit(k).alias("kind"), "event_id", "value") for k in kinds]
    )


@query("st_03_distinct", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def distinct(t: Tables) -> DataFrame:
    return t.lineitem.select("l_partkey", "l_suppkey").distinct()


@query(
    "st_04_identical_rows",
    """SELECT DISTINCT * FROM (SELECT event_id, user_id, value FROM events UNION ALL
         SELECT event_id, user_id, value FROM events WHERE event_type = 'click')""",
)
def identical_rows(t: Tables) -> DataFrame:
    some = t.events.select("event_id", "user_id", "value")
    again = t.events.where(F.col("event_type") == "click").select("event_id", "user_id", "value")
    return some.unionByName(again).dropDuplicates()


@query("st_05_distinct_keys", "SELECT DISTINCT user_id, event_type FROM events")
def distinct_keys(t: Tables) -> DataFrame:
    """The survivor per key is arbitrary, so only the keys are kept."""
    return t.events.dropDuplicates(["user_id", "event_type"]).select("user_id", "event_type")


@query(
    "st_06_smallest_id",
    """SELECT min(event_id) AS event_id, user_id, event_type, CAST(ts AS DATE) AS day FROM events GROUP BY 2, 3, 4""",
)
def first_of_day(t: Tables) -> DataFrame:
    return smallest_id(t.events, ["user_id", "event_type", F.to_date("ts").alias("day")], "event_id")


@query(
    "st_07_latest_nulls_last",
    """SELECT user_id, event_id, seen FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY seen DESC NULLS LAST,
         event_id DESC) AS rn FROM (SELECT user_id, event_id, CASE WHEN event_type = 'error' THEN NULL ELSE ts END AS seen FROM events))
       WHERE rn = 1""",
)
def latest_nulls_last(t: Tables) -> DataFrame:
    seen = F.when(F.col("event_type") != "error", F.col("ts"))
    return latest(t.events.select("user_id", "event_id", seen.alias("seen")), ["user_id"], "seen", "event_id")


@query(
    "st_08_near_duplicates",
    """WITH k AS (SELECT doc_id, lang, source, sha256(trim(regexp_replace(lower(text), '[^\\p{L}\\p{N}]+', ' ', 'g'))) AS k
         FROM documents)
       SELECT doc_id, lang, source FROM k WHERE doc_id IN (SELECT min(doc_id) FROM k GROUP BY k)""",
)
def near_duplicates(t: Tables) -> DataFrame:
    """Texts equal but for case, punctuation and spacing count as one; whole texts are compared."""
    return drop_copies(t.documents, text_key("text"), "doc_id").select("doc_id", "lang", "source")


@query(
    "st_08_copy_groups",
    """WITH k AS (SELECT doc_id, sha256(trim(regexp_replace(lower(text), '[^\\p{L}\\p{N}]+', ' ', 'g'))) AS k FROM documents)
       SELECT k AS text_key, min(doc_id) AS doc_id, count(*) AS n_copies FROM k GROUP BY 1 HAVING count(*) > 1""",
)
def copy_groups(t: Tables) -> DataFrame:
    return (
        t.documents.groupBy(F.sha2(squeezed("text"), 256).alias("text_key"))
        .agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n_copies"))
        .where("n_copies > 1")
    )


_SIMILAR = """WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split(
      trim(regexp_replace(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+', ' ', 'g')), ' '), lambda x: x <> '') AS w FROM documents),
  g AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM w),
  n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY 1),
  both_in AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM g a JOIN g b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
  link AS MATERIALIZED (SELECT a, b FROM both_in JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
  way AS MATERIALIZED (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
  reach AS (SELECT doc_id, doc_id AS root FROM documents UNION SELECT way.b, reach.root FROM reach JOIN way ON way.a = reach.doc_id),
  grp AS (SELECT doc_id, min(root) AS group_id FROM reach GROUP BY 1)"""


@query("st_08_minhash_groups", f"{_SIMILAR} SELECT doc_id, group_id FROM grp")
def minhash_groups(t: Tables) -> DataFrame:
    """Texts of Jaccard similarity 0.75 over five-word shingles, and what they are linked with."""
    return similar_groups(t.documents, "text", "doc_id")


@query(
    "st_08_similar_dropped",
    f"{_SIMILAR} SELECT documents.doc_id, lang, source FROM documents JOIN grp ON documents.doc_id = grp.doc_id WHERE grp.doc_id = group_id",
)
def similar_dropped(t: Tables) -> DataFrame:
    return drop_similar(t.documents, "text", "doc_id").select("doc_id", "lang", "source")
