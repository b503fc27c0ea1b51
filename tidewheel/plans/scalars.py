"""Projections, filters and scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.functions.text import clean, clean_any_space
from tidewheel.functions.times import epoch_seconds
from tidewheel.operators.samples import exact_sample
from tidewheel.plans.registry import Tables, query
from tidewheel.plans.reports import year_range


@query("prj_01_select", "SELECT o_orderkey, o_totalprice FROM orders")
def select_columns(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_totalprice")


@query("prj_02_select_expr", "SELECT o_orderkey, o_totalprice * 2 AS doubled FROM orders")
def select_expr(t: Tables) -> DataFrame:
    return t.orders.selectExpr("o_orderkey", "o_totalprice * 2 AS doubled")


@query(
    "prj_03_derived",
    """SELECT l_orderkey, l_linenumber, l_extendedprice / l_quantity AS unit_price,
         l_extendedprice * 1.2e0 AS taxed, l_extendedprice - l_quantity AS delta FROM lineitem""",
)
def derived(t: Tables) -> DataFrame:
    price = F.col("l_extendedprice")
    return t.lineitem.withColumns(
        {
            "unit_price": price / F.col("l_quantity"),
            "taxed": price * 1.2,
            "delta": price - F.col("l_quantity"),
        }
    ).select("l_orderkey", "l_linenumber", "unit_price", "taxed", "delta")


@query(
    "prj_04_rename_drop",
    "SELECT c_custkey AS customer_id, c_name AS customer, c_mktsegment FROM customer",
)
def rename_drop(t: Tables) -> DataFrame:
    return (
        t.customer.withColumnRenamed("c_custkey", "customer_id")
        .withColumn("customer", F.col("c_name"))
        .drop("c_name", "c_nationkey", "c_acctbal")
    )


@query(
    "prj_05_when_buckets",
    """SELECT o_orderkey, CASE WHEN o_totalprice < 100000 THEN 'low' WHEN o_totalprice < 300000 THEN 'mid'
         ELSE 'high' END AS bucket, CASE o_custkey % 3 WHEN 0 THEN 'enterprise' WHEN 1 THEN 'mid'
         ELSE 'smb' END AS segment FROM orders""",
)
def when_buckets(t: Tables) -> DataFrame:
    price, part = F.col("o_totalprice"), F.col("o_custkey") % 3
    return t.orders.select(
        "o_orderkey",
        F.when(price < 100000, "low").when(price < 300000, "mid").otherwise("high").alias("bucket"),
        F.when(part == 0, "enterprise").when(part == 1, "mid").otherwise("smb").alias("segment"),
    )


@query(
    "prj_06_casts",
    """SELECT event_id, CAST(user_id AS INTEGER) AS as_int, CAST(floor(value) AS BIGINT) AS as_long,
         CAST(ts AS DATE) AS as_date, TRY_CAST(props AS DOUBLE) AS not_a_number,
         TRY_CAST(CASE WHEN event_id % 2 = 0 THEN 'x' ELSE '7' END AS BIGINT) AS maybe FROM events""",
)
def casts(t: Tables) -> DataFrame:
    dirty = F.when(F.col("event_id") % 2 == 0, "x").otherwise("7")
    return t.events.select(
        "event_id",
        F.col("user_id").cast("int").alias("as_int"),
        F.floor("value").cast("bigint").alias("as_long"),
        F.col("ts").cast("date").alias("as_date"),
        F.col("props").try_cast("double").alias("not_a_number"),
        dirty.try_cast("bigint").alias("maybe"),
    )


@query(
    "prj_07_typed_null",
    "SELECT c_custkey, CAST(NULL AS DATE) AS effective_to, TRUE AS is_current FROM customer",
)
def typed_null(t: Tables) -> DataFrame:
    return t.customer.select(
        "c_custkey", F.lit(None).cast("date").alias("effective_to"), F.lit(True).alias("is_current")
    )


@query(
    "prj_08_one_select",
    "SELECT event_id, "
    + ", ".join(f"round(value * {i}, 2) AS value_x{i}" for i in range(1, 13))
    + " FROM events",
)
def one_select(t: Tables) -> DataFrame:
    many = [F.round(F.col("value") * i, 2).alias(f"value_x{i}") for i in range(1, 13)]
    return t.events.select("event_id", *many)


@query(
    "flt_1_2_comparisons",
    """SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
       WHERE (o_totalprice >= 100000 AND o_totalprice < 200000 AND o_orderstatus <> 'P')
          OR NOT (o_orderkey > 10 OR o_custkey = 3)""",
)
def comparisons(t: Tables) -> DataFrame:
    price = F.col("o_totalprice")
    middle = (price >= 100000) & (price < 200000) & (F.col("o_orderstatus") != "P")
    return t.orders.where(middle | ~((F.col("o_orderkey") > 10) | (F.col("o_custkey") == 3))).select(
        "o_orderkey", "o_orderstatus", "o_totalprice"
    )


@query(
    "flt_3_null_tests",
    """SELECT doc_id, quality IS NULL AS unlabelled FROM documents LEFT JOIN labels USING (doc_id)
       WHERE quality IS NULL OR toxic IS NOT NULL""",
)
def null_tests(t: Tables) -> DataFrame:
    both = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    return both.where(F.col("quality").isNull() | F.col("toxic").isNotNull()).select(
        "doc_id", F.col("quality").isNull().alias("unlabelled")
    )


@query(
    "flt_4_isin",
    "SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'purchase')",
)
def isin(t: Tables) -> DataFrame:
    return t.events.where(F.col("event_type").isin("click", "purchase")).select("event_id", "event_type")


@query(
    "flt_5_between",
    """SELECT doc_id, quality BETWEEN 1 AND 1 AS good FROM documents LEFT JOIN labels USING (doc_id)""",
)
def between(t: Tables) -> DataFrame:
    return t.documents.select("doc_id").join(t.labels, "doc_id", "left").select(
        "doc_id", F.col("quality").between(1, 1).alias("good")
    )


@query(
    "flt_6_filter_first",
    """SELECT c_mktsegment, count(*) AS n_orders, round(sum(o_totalprice), 2) AS revenue
       FROM orders JOIN customer ON o_custkey = c_custkey
       WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'
         AND c_mktsegment = 'BUILDING' GROUP BY 1""",
)
def filter_first(t: Tables) -> DataFrame:
    orders = t.orders.where(year_range("o_orderdate", 1997)).select("o_custkey", "o_totalprice")
    customers = t.customer.where(F.col("c_mktsegment") == "BUILDING").select("c_custkey", "c_mktsegment")
    return (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_mktsegment")
        .agg(F.count("*").alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("revenue"))
    )


@query(
    "flt_7_typed_filter",
    """SELECT event_id, CAST(props->>'k' AS INTEGER) AS k FROM events WHERE CAST(props->>'k' AS INTEGER) >= 50""",
)
def typed_filter(t: Tables) -> DataFrame:
    typed = t.events.select("event_id", F.from_json("props", "k INT").getField("k").alias("k"))
    return typed.where(F.col("k") >= 50)


@query("flt_8_sample")
def sample(t: Tables) -> DataFrame:
    return t.lineitem.sample(fraction=0.1, seed=7).select("l_orderkey", "l_linenumber")


@query(
    "flt_8_exact_sample",
    """SELECT l_returnflag, l_orderkey, l_linenumber FROM (SELECT *, count(*) OVER (PARTITION BY l_returnflag) AS n,
       row_number() OVER (PARTITION BY l_returnflag ORDER BY md5(l_orderkey || '-' || l_linenumber)) AS k FROM lineitem)
       WHERE k <= (n * 10 + 99) // 100""",
)
def exact_tenth(t: Tables) -> DataFrame:
    """A tenth of each stratum, to the row, by digests that any engine can repeat."""
    rows = t.lineitem.select("l_returnflag", "l_orderkey", "l_linenumber")
    return exact_sample(rows, ["l_returnflag"], F.concat_ws("-", "l_orderkey", "l_linenumber"), 10)


@query(
    "fn_1_case_trim_length",
    """SELECT doc_id, lower(source) AS low, upper(lang) AS up, trim('  ' || source || ' ') AS trimmed,
         length(text) AS n, lower(regexp_replace(chr(9) || lang || chr(10), '^\\s+|\\s+$', '', 'g')) AS bare
       FROM documents""",
)
def case_trim_length(t: Tables) -> DataFrame:
    padded = F.concat(F.lit("\t"), F.col("lang"), F.lit("\n"))
    return t.documents.select(
        "doc_id",
        F.lower("source").alias("low"),
        F.upper("lang").alias("up"),
        F.trim(F.concat(F.lit("  "), "source", F.lit(" "))).alias("trimmed"),
        F.length("text").cast("bigint").alias("n"),
        clean_any_space(padded).alias("bare"),
    )


@query(
    "fn_2_concat_substring",
    """SELECT c_custkey, c_name || '/' || c_mktsegment AS joined, concat_ws('-', c_mktsegment, c_name) AS dashed,
         substring(c_name, 10, 9) AS digits FROM customer""",
)
def concat_substring(t: Tables) -> DataFrame:
    return t.customer.select(
        "c_custkey",
        F.concat("c_name", F.lit("/"), "c_mktsegment").alias("joined"),
        F.concat_ws("-", "c_mktsegment", "c_name").alias("dashed"),
        F.substring("c_name", 10, 9).alias("digits"),
    )


@query(
    "fn_3_regex_split",
    """SELECT page_id, regexp_replace(url, '[0-9]+', '#', 'g') AS masked,
         regexp_extract(url, '^(https?)://', 1) AS scheme, len(string_split(url, '/')) AS n_parts,
         string_split(url, '/')[3] AS host FROM pages""",
)
def regex_split(t: Tables) -> DataFrame:
    parts = F.split("url", "/")
    return t.pages.select(
        "page_id",
        F.regexp_replace("url", "[0-9]+", "#").alias("masked"),
        F.regexp_extract("url", "^(https?)://", 1).alias("scheme"),
        F.size(parts).cast("bigint").alias("n_parts"),
        parts.getItem(2).alias("host"),
    )


@query(
    "fn_4_coalesce_when",
    """SELECT doc_id, coalesce(quality, -1) AS quality, CASE WHEN toxic = 1 THEN 'toxic' WHEN toxic = 0 THEN 'clean'
         ELSE 'unknown' END AS verdict FROM documents LEFT JOIN labels USING (doc_id)""",
)
def coalesce_when(t: Tables) -> DataFrame:
    toxic = F.col("toxic")
    return t.documents.select("doc_id").join(t.labels, "doc_id", "left").select(
        "doc_id",
        F.coalesce("quality", F.lit(-1)).alias("quality"),
        F.when(toxic == 1, "toxic").when(toxic == 0, "clean").otherwise("unknown").alias("verdict"),
    )


@query(
    "fn_5_casts",
    """SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(12, 2)) AS exact, CAST(o_orderkey AS VARCHAR) AS text,
         CAST(o_orderdate AS DATE) AS day, TRY_CAST(o_orderpriority AS INTEGER) AS level FROM orders""",
)
def casts_between_types(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey",
        F.col("o_totalprice").cast("decimal(12,2)").alias("exact"),
        F.col("o_orderkey").cast("string").alias("text"),
        F.col("o_orderdate").cast("date").alias("day"),
        F.col("o_orderpriority").try_cast("int").alias("level"),
    )


@query(
    "fn_6_dates",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, strftime(o_orderdate, '%Y-%m') AS month_text,
         CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m,
         CAST(datediff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS age,
         CAST(strptime(strftime(o_orderdate, '%d/%m/%Y'), '%d/%m/%Y') AS TIMESTAMP) AS parsed
       FROM orders""",
)
def dates(t: Tables) -> DataFrame:
    at = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey",
        F.to_date(at).alias("day"),
        F.date_format(at, "yyyy-MM").alias("month_text"),
        F.year(at).alias("y"),
        F.month(at).alias("m"),
        F.datediff(at.cast("date"), F.lit("1995-01-01").cast("date")).alias("age"),
        F.to_timestamp_ntz(F.date_format(at, "dd/MM/yyyy"), F.lit("dd/MM/yyyy")).alias("parsed"),
    )


@query(
    "fn_7_epoch",
    """SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS seconds, CAST(ts AS DATE) - 7 AS week_ago,
         TIMESTAMP '1970-01-01' + to_seconds(CAST(floor(epoch(ts)) AS BIGINT)) AS whole_second,
         CAST(DATE '2024-02-01' - CAST(ts AS DATE) AS INTEGER) AS days_to_now FROM events""",
)
def epoch(t: Tables) -> DataFrame:
    # "Now" is a parameter, so that a run can be repeated.
    today = F.lit("2024-02-01").cast("date")
    seconds = epoch_seconds("ts")
    return t.events.select(
        "event_id",
        seconds.alias("seconds"),
        F.date_sub(F.col("ts").cast("date"), 7).alias("week_ago"),
        F.date_trunc("second", F.col("ts")).cast("timestamp_ntz").alias("whole_second"),
        F.datediff(today, F.col("ts").cast("date")).alias("days_to_now"),
    )


@query(
    "fn_8_time_zone",
    """SELECT event_id, (ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS local_ts FROM events""",
)
def time_zone(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id",
        F.convert_timezone(F.lit("UTC"), F.lit("America/New_York"), "ts").alias("local_ts"),
    )


@query(
    "fn_9_intervals",
    """SELECT event_id, ts - INTERVAL 25 HOUR AS day_before, ts + INTERVAL 1 DAY AS next_day FROM events
       WHERE ts > TIMESTAMP '2024-01-15' - INTERVAL 2 DAY""",
)
def intervals(t: Tables) -> DataFrame:
    from_ = F.lit("2024-01-15").cast("timestamp_ntz") - F.expr("INTERVAL 2 DAYS")
    return t.events.where(F.col("ts") > from_).select(
        "event_id",
        (F.col("ts") - F.expr("INTERVAL 25 HOURS")).alias("day_before"),
        (F.col("ts") + F.expr("INTERVAL 1 DAY")).alias("next_day"),
    )


@query(
    "fn_10_arithmetic",
    """SELECT c_custkey, round(c_acctbal, 0) AS r, CAST(floor(c_acctbal) AS BIGINT) AS f,
         CAST(ceil(c_acctbal) AS BIGINT) AS c, abs(c_acctbal) AS a, c_custkey % 7 AS m,
         ((c_custkey - 700) % 7 + 7) % 7 AS pm, c_acctbal / 4 AS q FROM customer""",
)
def arithmetic(t: Tables) -> DataFrame:
    bal, key = F.col("c_acctbal"), F.col("c_custkey")
    return t.customer.select(
        "c_custkey",
        F.round(bal, 0).alias("r"),
        F.floor(bal).alias("f"),
        F.ceil(bal).alias("c"),
        F.abs(bal).alias("a"),
        (key % 7).alias("m"),
        F.pmod(key - 700, F.lit(7)).cast("bigint").alias("pm"),
        (bal / 4).alias("q"),
    )


@query("fn_11_rand")
def rand(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.floor(F.rand(42) * 16).cast("int").alias("salt"))


@query(
    "fn_12_arrays",
    """SELECT event_id, unnest([1, 2, 3]) AS copy, user_id AS who, event_type AS what FROM events""",
)
def arrays(t: Tables) -> DataFrame:
    copy = F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("copy")
    pair = F.struct(F.col("user_id").alias("who"), F.col("event_type").alias("what"))
    return t.events.select("event_id", pair.alias("p"), copy).select("event_id", "copy", "p.*")


@query(
    "fn_13_predicates",
    """SELECT o_orderkey, o_totalprice BETWEEN 1000 AND 200000 AS mid, o_orderstatus IN ('F', 'O') AS done,
         o_orderdate IS NULL AS undated FROM orders""",
)
def predicates(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey",
        F.col("o_totalprice").between(1000, 200000).alias("mid"),
        F.col("o_orderstatus").isin("F", "O").alias("done"),
        F.col("o_orderdate").isNull().alias("undated"),
    )


@query("fn_14_partition_id")
def partition_id(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_linenumber", F.spark_partition_id().alias("pid"))


@query("fn_15_session_names")
def session_names(t: Tables) -> DataFrame:
    return t.orders.groupBy(
        F.current_catalog().alias("catalog"),
        F.current_database().alias("database"),
        F.current_user().alias("user"),
    ).agg(F.count("*").alias("n_orders"))


@query(
    "ud_3_builtin_for_udf",
    """SELECT lower(trim('  ' || p_type || ' ')) AS category, upper(p_brand) AS brand, CASE WHEN p_retailprice < 950 THEN 'low'
         WHEN p_retailprice < 1000 THEN 'mid' ELSE 'high' END AS bucket, count(*) AS n_parts FROM part GROUP BY 1, 2, 3""",
)
def builtin_for_udf(t: Tables) -> DataFrame:
    price = F.col("p_retailprice")
    bucket = F.when(price < 950, "low").when(price < 1000, "mid").otherwise("high")
    padded = F.concat(F.lit("  "), "p_type", F.lit(" "))
    return t.part.groupBy(
        clean(padded).alias("category"), F.upper("p_brand").alias("brand"), bucket.alias("bucket")
    ).agg(F.count("*").alias("n_parts"))
