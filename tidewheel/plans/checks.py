"""Data-quality queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.operators import quality as q
from tidewheel.operators.dedup import duplicate_keys
from tidewheel.plans.registry import Tables, query
from tidewheel.sources.sinks import run_only

# The checked rows: events with their labels, so that some values are NULL.
_ROWS = """WITH r AS (SELECT event_id % 9000 AS id, event_type AS kind, value, CASE WHEN event_id % 7 = 0 THEN NULL ELSE
  event_type || event_id || '@x.org' END AS email, CASE WHEN event_id % 11 = 0 THEN NULL ELSE value END AS amount FROM events)"""


def checked_rows(t: Tables) -> DataFrame:
    key = F.col("event_id")
    return t.events.select(
        (key % 9000).alias("id"),
        F.col("event_type").alias("kind"),
        "value",
        F.when(key % 7 != 0, F.concat("event_type", key.cast("string"), F.lit("@x.org"))).alias("email"),
        F.when(key % 11 != 0, F.col("value")).alias("amount"),
    )


def _line(rule: str, column: str, failed: str, wording: str, severity: str = "error") -> str:
    quoted = wording.replace("'", "''")
    return f"""SELECT '{rule}' AS rule, '{column}' AS "column", n = 0 AS passed, n AS failed_count,
      n || ' {quoted}' AS message, '{severity}' AS severity FROM (SELECT CAST({failed} AS BIGINT) AS n FROM r)"""


_PATTERN = "(click|view)[0-9]+@[^@]+[.]org"
_NOT_NULL = _line("NotNull", "email", "count(*) FILTER (email IS NULL)", "null values in 'email'")
_UNIQUE = _line(
    "Unique",
    "id",
    "count(*) - count(DISTINCT id) - CASE WHEN count(*) > count(id) THEN 1 ELSE 0 END",
    "duplicate values in 'id'",
)
_UNIQUE_NULLS = _line(
    "Unique",
    "email",
    "count(*) - count(DISTINCT email) - CASE WHEN count(*) > count(email) THEN 1 ELSE 0 END",
    "duplicate values in 'email'",
    "warning",
)
_RANGE = _line(
    "InRange",
    "amount",
    "count(*) FILTER (amount IS NULL OR amount < 1 OR amount > 200)",
    "values of 'amount' outside [1, 200]",
)
_REGEX = _line(
    "Regex",
    "email",
    f"count(*) FILTER (email IS NULL OR NOT regexp_full_match(email, '{_PATTERN}'))",
    f"values of 'email' fail pattern {_PATTERN}",
)
_ONE_OF = _line(
    "OneOf",
    "kind",
    "count(*) FILTER (kind IS NULL OR kind NOT IN ('click', 'view', 'purchase'))",
    "values of 'kind' not in the allowed set",
    "warning",
)
_ALL = " UNION ALL ".join([_NOT_NULL, _UNIQUE, _UNIQUE_NULLS, _RANGE, _REGEX, _ONE_OF])

CONFIG = [
    {"type": "NotNull", "column": "email"},
    {"type": "Unique", "column": "id"},
    {"type": "Unique", "column": "email", "severity": "warning"},
    {"type": "InRange", "column": "amount", "low": 1, "high": 200},
    {"type": "Regex", "column": "email", "pattern": _PATTERN},
    {"type": "OneOf", "column": "kind", "allowed": ["click", "view", "purchase"], "severity": "warning"},
]


@query("dq_01_not_null", f"{_ROWS} {_NOT_NULL}")
def not_null(t: Tables) -> DataFrame:
    return q.check(checked_rows(t), [q.not_null("email")])


@query("dq_02_unique", f"{_ROWS} {_UNIQUE} UNION ALL {_UNIQUE_NULLS}")
def unique(t: Tables) -> DataFrame:
    return q.check(checked_rows(t), [q.unique("id"), q.unique("email", "warning")])


@query("dq_03_in_range", f"{_ROWS} {_RANGE}")
def in_range(t: Tables) -> DataFrame:
    return q.check(checked_rows(t), [q.in_range("amount", 1, 200)])


@query("dq_04_regex", f"{_ROWS} {_REGEX}")
def regex(t: Tables) -> DataFrame:
    return q.check(checked_rows(t), [q.regex("email", _PATTERN)])


@query("dq_05_one_of", f"{_ROWS} {_ONE_OF}")
def one_of(t: Tables) -> DataFrame:
    return q.check(checked_rows(t), [q.one_of("kind", ["click", "view", "purchase"], "warning")])


@query("dq_06_severity", f"{_ROWS}, report AS ({_ALL}) SELECT bool_and(passed OR severity <> 'error') AS passed FROM report")
def severity(t: Tables) -> DataFrame:
    return q.blocks(q.check(checked_rows(t), q.rules_from(CONFIG)))


@query(
    "dq_07_resilient",
    f"""{_ROWS} {_NOT_NULL} UNION ALL SELECT 'InRange', 'missing', FALSE, -1, 'rule raised', 'error'""",
)
def resilient(t: Tables) -> DataFrame:
    """The rule on a missing column fails alone. Its message is cut to the part Spark does not word."""
    report = q.check(checked_rows(t), [q.not_null("email"), q.in_range("missing", 0, 1)])
    raised = F.col("failed_count") == -1
    return report.withColumn("message", F.when(raised, F.split("message", ":")[0]).otherwise(F.col("message")))


@query("dq_08_rules_from_config", f"{_ROWS} {_ALL}")
def from_config(t: Tables) -> DataFrame:
    return q.check(checked_rows(t), q.rules_from(CONFIG))


@query(
    "dq_09_summary",
    f"""{_ROWS}, report AS ({_ALL}) SELECT '[' || CASE WHEN passed THEN 'PASS' ELSE 'FAIL' END || '] ' || rule || '(' || "column"
        || '): ' || message AS line FROM report""",
)
def summary(t: Tables) -> DataFrame:
    return q.summary(q.check(checked_rows(t), q.rules_from(CONFIG)))


@query(
    "dq_09_stats",
    f"""{_ROWS}, report AS ({_ALL}) SELECT count(*) AS total_rules, count(*) FILTER (passed) AS passed, count(*) FILTER (NOT passed)
        AS failed, CAST(sum(greatest(failed_count, 0)) AS BIGINT) AS total_failed_records FROM report""",
)
def stats(t: Tables) -> DataFrame:
    return q.stats(q.check(checked_rows(t), q.rules_from(CONFIG)))


@query(
    "dq_10_gate",
    """SELECT count(*) AS n_rows, count(*) FILTER (o_totalprice < 0) AS negative, count(*) FILTER (o_custkey IS NULL) AS no_customer
       FROM orders""",
)
def gate(t: Tables) -> DataFrame:
    forbidden = {"negative": F.col("o_totalprice") < 0, "no_customer": F.col("o_custkey").isNull()}
    return q.gate_counts(q.gate(t.orders, forbidden), forbidden)


@query(
    "dq_11_duplicate_keys",
    f"{_ROWS} SELECT id, count(*) AS n_rows FROM r GROUP BY id HAVING count(*) > 1",
)
def duplicates(t: Tables) -> DataFrame:
    return duplicate_keys(checked_rows(t), ["id"])


@query(
    "dq_12_reconciled",
    """SELECT 'orders' AS step, count(*) AS n_rows, count(DISTINCT o_custkey) AS n_keys FROM orders UNION ALL
       SELECT 'customers', count(*), count(DISTINCT c_custkey) FROM customer UNION ALL
       SELECT 'joined', count(*), count(DISTINCT o_custkey) FROM orders JOIN customer ON o_custkey = c_custkey UNION ALL
       SELECT 'large', count(*), count(DISTINCT o_custkey) FROM orders JOIN customer ON o_custkey = c_custkey
         WHERE o_totalprice > 300000""",
)
def reconciled(t: Tables) -> DataFrame:
    orders = t.orders.select(F.col("o_custkey").alias("k"), "o_totalprice")
    customers = t.customer.select(F.col("c_custkey").alias("k"))
    joined = orders.join(customers, "k")
    steps = {
        "orders": orders,
        "customers": customers,
        "joined": joined,
        "large": joined.where(F.col("o_totalprice") > 300000),
    }
    return q.reconcile(steps, ["k"])


@query(
    "dq_12_counted_in_one_run",
    """SELECT 'orders' AS step, count(*) AS n_rows, count(*) FILTER (o_custkey IS NULL) AS null_k FROM orders UNION ALL
       SELECT 'customers', count(*), count(*) FILTER (c_custkey IS NULL) FROM customer UNION ALL
       SELECT 'joined', count(*), 0 FROM orders JOIN customer ON o_custkey = c_custkey UNION ALL
       SELECT 'large', count(*), 0 FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 300000""",
)
def counted_in_one_run(t: Tables) -> DataFrame:
    """The steps of a load counted while its result is written, each table read once."""
    counts = q.StepCounts(["k"])
    orders = counts.step("orders", t.orders.select(F.col("o_custkey").alias("k"), "o_totalprice"))
    customers = counts.step("customers", t.customer.select(F.col("c_custkey").alias("k")))
    joined = counts.step("joined", orders.join(customers, "k"))
    run_only(counts.step("large", joined.where(F.col("o_totalprice") > 300000)))
    return counts.report(t.spark).drop("place")
