from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.conftest import bag
from tidewheel.operators import joins
from tidewheel.operators.aggregates import salted_totals
from tidewheel.operators.dedup import drop_copies
from tidewheel.operators.skew import flag_hot, hot_keys, key_shares, partition_count, partition_rows
from tidewheel.functions.text import clean, clean_any_space, text_key


@pytest.fixture(scope="module")
def fact(spark):
    """Key 0 has 60 of 110 rows; ten rows have no key."""
    return spark.range(110).select(
        "id", F.when(F.col("id") < 60, 0).when(F.col("id") < 100, F.col("id") % 7).alias("k"), (F.col("id") * 1.5).alias("v")
    )


@pytest.fixture(scope="module")
def dim(spark):
    return spark.range(5).select(F.col("id").alias("k"), F.concat(F.lit("d"), "id").alias("name"))


def test_skew_joins_equal_the_plain_join(fact, dim):
    want = bag(fact.join(dim, "k"), "k", "id", "v", "name")
    assert want
    assert bag(joins.salted_join(fact, dim, ["k"], ["id"], 4), "k", "id", "v", "name") == want
    for share in (0.3, 1e-6, 0.99):
        assert bag(joins.hot_salted_join(fact, dim, ["k"], ["id"], 4, share), "k", "id", "v", "name") == want
        assert bag(joins.hot_split_join(fact, dim, ["k"], share), "k", "id", "v", "name") == want
    assert bag(joins.co_partitioned_join(fact, dim, ["k"], 3), "k", "id", "v", "name") == want


def test_salting_with_repeated_dimension_keys(fact, dim):
    twice = dim.unionByName(dim.withColumn("name", F.lit("again")))
    want = bag(fact.join(twice, "k"), "k", "id", "name")
    assert bag(joins.hot_salted_join(fact, twice, ["k"], ["id"], 4, 0.3), "k", "id", "name") == want


def test_small_side_join_checks_the_size(fact, dim):
    def plan(limit):
        return joins.small_side_join(fact, dim, "k", limit=limit)._jdf.queryExecution().optimizedPlan().toString()

    assert "strategy=broadcast" in plan(1 << 20)
    assert "strategy=broadcast" not in plan(10)
    want = bag(fact.join(dim, "k"), "id", "name")
    assert bag(joins.small_side_join(fact, dim, "k", limit=10), "id", "name") == want


def test_hot_keys(fact):
    assert bag(hot_keys(fact, ["k"], 0.3)) == [(0,)]
    assert bag(hot_keys(fact, ["k"], 0.3, min_rows=1000)) == []
    shares = {k: s for k, _, s in bag(key_shares(fact, ["k"]))}
    assert abs(sum(shares.values()) - 1) < 1e-9
    flagged = flag_hot(fact, ["k"], share=0.09)
    # NULL keys (ten of 110 rows) are a group that can be hot.
    assert {r[0] for r in bag(flagged.where("is_hot"), "k")} == {None, 0}
    assert flagged.count() == 110


def test_either_key_counts_a_double_match_once(spark):
    left = spark.createDataFrame([(1, 10, 20), (2, 11, 21), (3, None, 20), (4, 12, None)], "id INT, a INT, b INT")
    right = spark.createDataFrame([(10, 20, "both"), (99, 21, "second"), (12, 7, "first")], "c INT, d INT, tag STRING")
    pairs = [(F.col("a"), F.col("c")), (F.col("b"), F.col("d"))]
    out = joins.either_key_join(left, right, pairs)
    assert bag(out, "id", "tag") == [(1, "both"), (2, "second"), (3, "both"), (4, "first")]
    plain = left.join(right, (F.col("a") == F.col("c")) | (F.col("b") == F.col("d")))
    assert bag(out, "id", "tag") == bag(plain, "id", "tag")


def test_not_in_trap(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k INT")
    right = spark.createDataFrame([(1,), (None,)], "k INT")
    left.createOrReplaceTempView("trap_l")
    right.createOrReplaceTempView("trap_r")
    assert spark.sql("SELECT * FROM trap_l WHERE k NOT IN (SELECT k FROM trap_r)").count() == 0
    assert bag(joins.without_match(left, right, ["k"])) == [(None,), (2,)]


def test_left_join_keeps_null_keys(fact, dim):
    out = joins.left_join_flagged(fact, dim, ["k"])
    plain = fact.join(dim, "k", "left")
    assert bag(out, "id", "k", "name") == bag(plain, "id", "k", "name")
    assert out.where("matched").count() == fact.join(dim, "k").count()


def test_fan_out_guard(spark, fact, dim):
    many = dim.unionByName(dim).withColumn("w", F.lit(2))
    out = joins.one_row_per_key_join(fact, many, ["k"], {"w": F.sum("w")})
    assert out.count() == fact.count()
    assert out.where("k = 0").first()["w"] == 4


def test_salted_totals(fact):
    want = bag(fact.groupBy("k").agg(F.sum("v").alias("t"), F.count("v").alias("n"), F.avg("v").alias("m")))
    assert bag(salted_totals(fact, ["k"], "v", ["id"], 4)) == want


def test_partition_reports(fact):
    three = fact.repartition(3)
    assert sum(n for _, n in bag(partition_rows(three))) == 110
    assert partition_count(three).first()[0] == 3


def test_text_clean_up(spark):
    df = spark.createDataFrame([(1, "\t Ab c \n"), (2, "  ab C "), (3, None), (4, "")], "id INT, s STRING")
    assert bag(df, "id", clean("s").alias("c")) == [(1, "\t ab c \n"), (2, "ab c"), (3, None), (4, "")]
    assert bag(df, "id", clean_any_space("s").alias("c")) == [(1, "ab c"), (2, "ab c"), (3, None), (4, "")]


def test_copies_keep_the_smallest_id(spark):
    texts = [(3, "Hello, World!"), (1, "hello  world"), (2, "other"), (5, "HELLO-WORLD"), (4, "Other.")]
    df = spark.createDataFrame(texts, "id INT, s STRING")
    assert bag(drop_copies(df, text_key("s"), "id"), "id") == [(1,), (2,)]
