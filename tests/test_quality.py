from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.conftest import bag
from tidewheel.operators import quality as q

EMAIL = r"[^@]+@[^@]+\.[^@]+"


@pytest.fixture(scope="module")
def people(spark):
    # Fixed values.
    return spark.createDataFrame([(1, "a@x.com", 30), (2, None, 200), (2, "c@x.com", 25)], "id INT, email STRING, age INT")


def failed(df, *rules):
    return [r["failed_count"] for r in q.check(df, rules).collect()]


def test_rules(people):
    rules = [q.not_null("email"), q.unique("id"), q.in_range("age", 0, 120), q.regex("email", EMAIL)]
    assert failed(people, *rules) == [1, 1, 1, 1]
    assert q.check(people, rules).schema == q.REPORT_SCHEMA or [f.name for f in q.check(people, rules).schema] == [
        f.name for f in q.REPORT_SCHEMA
    ]


def test_edges(spark):
    numbers = spark.createDataFrame([(1,), (2,), (2,), (2,)], "n INT")
    nulls = spark.createDataFrame([(None,), (None,), (1,)], "n INT")
    assert failed(numbers, q.unique("n")) == [2]
    assert failed(nulls, q.unique("n"), q.in_range("n", 0, 5), q.not_null("n")) == [1, 2, 2]
    empty = numbers.limit(0)
    assert failed(empty, q.unique("n"), q.in_range("n", 0, 5), q.not_null("n")) == [0, 0, 0]
    status = spark.createDataFrame([("completed",), ("COMPLETED",), ("pending",), ("invalid",)], "s STRING")
    assert failed(status, q.one_of("s", ["completed", "pending"])) == [2]


def test_regex_matches_the_whole_value(spark):
    df = spark.createDataFrame([("a@x.com",), ("a@x.com\n",), ("x a@x.com.",), ("nope",), (None,)], "e STRING")
    assert failed(df, q.regex("e", "[a-z]@x.com")) == [4]
    assert failed(df, q.regex("e", "nope|a@x.com")) == [3]
    numbers = spark.createDataFrame([(12,), (123,)], "n INT")
    assert failed(numbers, q.regex("n", "[0-9]{2}")) == [1]


def test_warnings_do_not_block(people):
    warn = q.check(people, [q.not_null("email", "warning")])
    assert q.blocks(warn).first()["passed"] is True
    error = q.check(people, [q.not_null("email", "warning"), q.unique("id")])
    assert q.blocks(error).first()["passed"] is False
    assert q.check(people, [q.not_null("email", "warning")]).first()["severity"] == "warning"


def test_a_broken_rule_fails_alone(people):
    report = q.check(people, [q.in_range("missing", 0, 1), q.regex("email", "("), q.not_null("email")])
    rows = report.collect()
    assert [r["failed_count"] for r in rows] == [-1, -1, 1]
    assert not any(r["passed"] for r in rows)
    assert rows[0]["message"].startswith("rule raised: ") and rows[1]["message"].startswith("rule raised: ")
    only = q.check(people, [q.not_null("missing")])
    assert only.first()["failed_count"] == -1


def test_config_summary_and_stats(people):
    config = [{"type": "NotNull", "column": "email"}, {"type": "InRange", "column": "age", "low": 0, "high": 300}]
    before = [dict(c) for c in config]
    report = q.check(people, [*q.rules_from(config), q.not_null("missing")])
    assert config == before
    lines = [r[0] for r in q.summary(report).collect()]
    assert lines[0] == "[FAIL] NotNull(email): 1 null values in 'email'"
    assert lines[1] == "[PASS] InRange(age): 0 values of 'age' outside [0, 300]"
    assert tuple(q.stats(report).first()) == (3, 1, 2, 1)
    with pytest.raises(KeyError):
        q.rules_from([{"type": "Nope", "column": "x"}])


def test_all_rules_read_the_data_once(people):
    rules = [q.not_null("email"), q.in_range("age", 0, 120), q.regex("email", EMAIL), q.one_of("id", [1, 2])]
    plan = q.check(people, rules)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1


def test_gate(people):
    forbidden = {"negative": F.col("age") < 0}
    assert q.gate(people, forbidden) is people
    with pytest.raises(q.GateFailed, match="no rows"):
        q.gate(people.limit(0), forbidden)
    with pytest.raises(q.GateFailed, match="1 rows: no email"):
        q.gate(people, {"no email": F.col("email").isNull()})


def test_reconcile(people):
    out = q.reconcile({"all": people, "with email": people.where("email IS NOT NULL")}, ["id"])
    assert bag(out) == [("all", 3, 2), ("with email", 2, 2)]


def test_a_rule_on_the_wrong_type_fails_alone(spark):
    from tidewheel.operators.quality import check, in_range, not_null

    df = spark.createDataFrame([("5", 1), ("x@y", 2), (None, None)], "email STRING, id INT")
    lines = {r.rule: r for r in check(df, [in_range("email", 0, 120), not_null("id"), in_range("id", 0, 1)]).collect() if r.rule != "InRange" or r.column == "email"}
    assert lines["InRange"].failed_count == -1 and not lines["InRange"].passed and "raised" in lines["InRange"].message
    assert lines["NotNull"].failed_count == 1


def test_steps_are_counted_in_one_run(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k long, v string")
    counts = q.StepCounts(["k"])
    kept = counts.step("kept", counts.step("read", rows).join(counts.step("names", spark.range(1, 2).withColumnRenamed("id", "k")), "k").where("v <> 'a'"))
    assert kept._jdf.queryExecution().executedPlan().toString().count("CollectMetrics") == 3
    kept.write.format("noop").mode("overwrite").save()
    assert bag(counts.report(spark), "step", "n_rows", "null_k") == [("kept", 1, 0), ("names", 1, 0), ("read", 4, 1)]
