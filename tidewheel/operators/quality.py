"""Data-quality rules, all checked in one pass.

A report has one row per rule: (rule, column, passed, failed_count, message, severity).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Rule:
    """A named check of one column. ``failed`` is an aggregate that counts failing rows."""

    name: str
    column: str
    failed: Column
    wording: str
    severity: str = "error"
    probe: Column | None = None


def not_null(column: str, severity: str = "error") -> Rule:
    failed = F.count_if(F.col(column).isNull())
    return Rule("NotNull", column, failed, f"null values in '{column}'", severity)


def unique(column: str, severity: str = "error") -> Rule:
    """Counts repeats: a value seen k times fails k - 1 times, and NULL is a value like others."""
    some_null = (F.count("*") > F.count(column)).cast("bigint")
    failed = F.count("*") - F.count_distinct(column) - some_null
    return Rule("Unique", column, failed, f"duplicate values in '{column}'", severity)


def in_range(column: str, low: float, high: float, severity: str = "error") -> Rule:
    number = F.col(column).try_cast("double")
    failed = F.count_if(~F.coalesce(number.between(low, high), F.lit(False)))
    # a value that is there and no number makes the rule itself fail, not the run
    failed = F.when(F.count_if(F.col(column).isNotNull() & number.isNull()) > 0, F.lit(-1)).otherwise(failed)
    return Rule("InRange", column, failed, f"values of '{column}' outside [{low}, {high}]", severity)


def regex(column: str, pattern: str, severity: str = "error") -> Rule:
    """The whole value must match; NULL fails."""
    whole = f"\\A(?:{pattern})\\z"
    fits = F.coalesce(F.col(column).cast("string").rlike(whole), F.lit(False))
    return Rule(
        "Regex",
        column,
        F.count_if(~fits),
        f"values of '{column}' fail pattern {pattern}",
        severity,
        F.lit("").rlike(whole),
    )


def one_of(column: str, allowed: Sequence, severity: str = "error") -> Rule:
    failed = F.count_if(~F.coalesce(F.col(column).isin(list(allowed)), F.lit(False)))
    return Rule("OneOf", column, failed, f"values of '{column}' not in the allowed set", severity)


RULES: dict[str, Callable[..., Rule]] = {
    "NotNull": not_null,
    "Unique": unique,
    "InRange": in_range,
    "Regex": regex,
    "OneOf": one_of,
}


def rules_from(config: Sequence[dict]) -> list[Rule]:
    """Rules from dicts such as ``{"type": "InRange", "column": "age", "low": 0, "high": 9}``."""
    return [
        RULES[spec["type"]](**{k: v for k, v in spec.items() if k != "type"}) for spec in config
    ]


def _problem(df: DataFrame, rule: Rule) -> str | None:
    """Why a rule cannot run, or None. Only plans are made, no data is read."""
    try:
        df.agg(rule.failed.alias("n")).schema
        if rule.probe is not None:
            df.sparkSession.range(1).select(rule.probe.alias("p")).first()
    except PySparkException as exc:
        return str(exc).splitlines()[0]
    return None


def _line(rule: Rule, count: Column, message: Column, passed: Column) -> Column:
    return F.struct(
        F.lit(rule.name).alias("rule"),
        F.lit(rule.column).alias("column"),
        passed.alias("passed"),
        count.cast("bigint").alias("failed_count"),
        message.alias("message"),
        F.lit(rule.severity).alias("severity"),
    )


def check(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Report of all rules from one aggregate over ``df``.

    A rule that cannot run fails with count -1 and does not stop the others.
    """
    problems = [_problem(df, rule) for rule in rules]
    counts = [r.failed.alias(f"n{i}") for i, r in enumerate(rules) if problems[i] is None]
    found = df.agg(*(counts or [F.count("*").alias("n")]))
    lines = []
    for i, rule in enumerate(rules):
        if problems[i] is None:
            n = F.col(f"n{i}")
            told = F.concat(n.cast("string"), F.lit(f" {rule.wording}"))
            cannot = F.lit(f"rule raised: '{rule.column}' holds values that cannot be compared")
            lines.append(_line(rule, n, F.when(n < 0, cannot).otherwise(told), n == 0))
        else:
            text = F.lit(f"rule raised: {problems[i]}")
            lines.append(_line(rule, F.lit(-1), text, F.lit(False)))
    return found.select(F.explode(F.array(*lines)).alias("line")).select("line.*")


def blocks(report: DataFrame) -> DataFrame:
    """One row: does a rule of severity error fail?"""
    failing = ~F.col("passed") & (F.col("severity") == "error")
    return report.agg((F.count_if(failing) == 0).alias("passed"))


def summary(report: DataFrame) -> DataFrame:
    """One text line per rule."""
    mark = F.when(F.col("passed"), "PASS").otherwise("FAIL")
    return report.select(
        F.format_string("[%s] %s(%s): %s", mark, "rule", "column", "message").alias("line")
    )


def stats(report: DataFrame) -> DataFrame:
    """Totals over a report; a rule that could not run adds no failed records."""
    return report.agg(
        F.count("*").alias("total_rules"),
        F.count_if("passed").alias("passed"),
        F.count_if(~F.col("passed")).alias("failed"),
        F.sum(F.greatest("failed_count", F.lit(0))).alias("total_failed_records"),
    )


class GateFailed(ValueError):
    """A load was stopped by its checks."""


def gate_counts(df: DataFrame, forbidden: dict[str, Column]) -> DataFrame:
    """One row: number of rows, and of rows that meet each forbidden condition."""
    return df.agg(
        F.count("*").alias("n_rows"), *[F.count_if(cond).alias(n) for n, cond in forbidden.items()]
    )


def gate(df: DataFrame, forbidden: dict[str, Column]) -> DataFrame:
    """Return ``df`` if it has rows and none is forbidden, else raise. One pass."""
    found = gate_counts(df, forbidden).first().asDict()
    problems = [] if found.pop("n_rows") else ["no rows"]
    problems += [f"{n} rows: {name}" for name, n in found.items() if n]
    if problems:
        raise GateFailed("; ".join(problems))
    return df


def reconcile(steps: dict[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Rows and distinct keys after each step, to see where rows go."""
    from tidewheel.operators.dedup import union_all

    key = F.struct(*keys)
    return union_all(
        [
            df.agg(F.count("*").alias("n_rows"), F.count_distinct(key).alias("n_keys")).select(
                F.lit(step).alias("step"), "n_rows", "n_keys"
            )
            for step, df in steps.items()
        ]
    )


class StepCounts:
    """Rows, and rows without a key, of every step of a load, counted while its result is written.

    Wrap each step with :meth:`step`, run the last one once, then ask for :meth:`report`: no step is
    computed a second time for its numbers. A filter is not moved below a counted step.
    """

    def __init__(self, keys: Sequence[str]):
        self.keys = list(keys)
        self.seen: dict[str, Observation] = {}

    def step(self, name: str, df: DataFrame) -> DataFrame:
        self.seen[name] = Observation(f"step-{uuid.uuid4().hex}")
        some = [F.count_if(F.col(k).isNull()).alias(f"null_{k}") for k in self.keys]
        return df.observe(self.seen[name], F.count("*").alias("n_rows"), *some)

    def report(self, spark: SparkSession) -> DataFrame:
        """One row per step in the order of the calls; waits for the run to end."""
        found = {name: seen.get for name, seen in self.seen.items()}
        rows = [(k, name, m["n_rows"], *[m[f"null_{c}"] for c in self.keys]) for k, (name, m) in enumerate(found.items())]
        return spark.createDataFrame(rows, "place INT, step STRING, n_rows BIGINT" + "".join(f", null_{c} BIGINT" for c in self.keys))


REPORT_SCHEMA = T.StructType(
    [
        T.StructField("rule", T.StringType()),
        T.StructField("column", T.StringType()),
        T.StructField("passed", T.BooleanType()),
        T.StructField("failed_count", T.LongType()),
        T.StructField("message", T.StringType()),
        T.StructField("severity", T.StringType()),
    ]
)
