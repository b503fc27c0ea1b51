"""Stored sketches, exact samples, changing schemas and merged small files."""

from __future__ import annotations

import glob
import hashlib
import json
import os
import random
from collections import defaultdict

from pyspark.sql import functions as F

from tests.conftest import bag
from tidewheel.operators.joins import needed_join
from tidewheel.operators.layout import _best_fit, compact_small
from tidewheel.operators.samples import exact_sample
from tidewheel.operators.sketches import DISTINCT_BOUND, RANK_BOUND, merged_sketches, unit_sketches
from tidewheel.sources.landing import land, log_schema, logged_schema, read_landed
from tidewheel.sources.sinks import materialised


def test_sketches_merge_to_any_span(spark):
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 10).alias("day"),  # day 0 holds a third and more
        F.when(F.col("id") % 7 > 0, F.pmod(F.xxhash64("id"), F.lit(20_000))).alias("who"),
        F.when(F.col("id") % 11 > 0, F.col("id") % 5_000).cast("double").alias("n"),
    )
    stored = materialised(unit_sketches(rows, F.col("day"), "who", "n"), "sketches")
    assert stored.count() == 10
    for span in (F.floor(F.col("unit") / 4), F.lit(1)):
        for r in merged_sketches(stored, span, 0.9).collect():
            part = rows.where((F.floor(F.col("day") / 4) == r.span) if r.n_units < 10 else F.lit(True))
            n, users, below = part.agg(F.count("*"), F.count_distinct("who"), F.avg((F.col("n") <= r.quantile).cast("int"))).first()
            assert r.n_rows == n and abs(r["distinct"] - users) <= DISTINCT_BOUND * users and abs(below - 0.9) <= RANK_BOUND + 0.001


def test_exact_sample(spark):
    rows = [(None if k % 5 == 0 else "hot" if k % 3 else f"s{k % 4}", k) for k in range(3_000)]
    df = spark.createDataFrame(rows, "s string, k long")
    groups = defaultdict(list)
    for s, k in rows:
        groups[s].append(k)
    want = [(s, k) for s, ks in groups.items() for k in sorted(ks, key=lambda k: hashlib.md5(str(k).encode()).hexdigest())[: -(-len(ks) // 10)]]
    key = lambda r: tuple((v is not None, v) for v in r)
    assert bag(exact_sample(df, ["s"], F.col("k"), 10)) == sorted(want, key=key)
    assert bag(exact_sample(df.repartition(5), ["s"], F.col("k"), 10)) == sorted(want, key=key)
    assert exact_sample(df.limit(0), ["s"], F.col("k"), 10).count() == 0


def test_new_fields_and_changed_types_lose_nothing(spark, folder):
    log_schema(spark, folder, 0, {"id": "bigint", "price": "double"})
    deliveries = [
        [{"id": 1, "price": 2.5}, {"id": 2}],
        [{"id": 3, "price": 1.0, "tag": "a", "n": 7}, {"id": 4, "price": None, "tag": "7", "sub": {"x": [1, 2]}}],
        [{"id": "five", "price": "2 EUR", "tag": "b", "n": "many"}, {"id": 6, "price": 3, "n": 8}],
        ["{broken", {"id": 9, "n": 10}],
    ]
    os.makedirs(f"{folder}/inbox")
    for k, rows in enumerate(deliveries):
        with open(f"{folder}/inbox/{k}.json", "w") as out:
            out.write("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows))
        land(spark, f"{folder}/inbox", folder)
    assert logged_schema(spark, folder) == (1, {"id": "bigint", "price": "double", "n": "bigint", "sub": "string", "tag": "string"})
    got = sorted(((r.id, r.price, r.n, r["sub"], r.tag, r._rescued) for r in read_landed(spark, folder).collect()), key=str)
    assert got == sorted(
        [
            (1, 2.5, None, None, None, {}), (2, None, None, None, None, {}), (3, 1.0, 7, None, "a", {}),
            (4, None, None, '{"x":[1,2]}', "7", {}), (None, None, None, None, "b", {"id": "five", "price": "2 EUR", "n": "many"}),
            (6, 3.0, 8, None, None, {}), (None, None, None, None, None, {"_line": "{broken"}), (9, None, 10, None, None, {}),
        ],
        key=str,
    )


def test_best_fit():
    rnd = random.Random(1)
    for _ in range(50):
        sizes = [rnd.randrange(1, 60) for _ in range(rnd.randrange(1, 40))]
        place = _best_fit(sizes, 100)
        held = defaultdict(int)
        for s, b in zip(sizes, place, strict=True):
            held[b] += s
        assert max(held.values()) <= 100 and len(held) <= 1.25 * -(-sum(sizes) // 100) + 1


def test_only_small_files_are_merged(spark, folder):
    path = f"{folder}/t"
    rows = spark.range(40_000).select("id", F.when(F.col("id") % 3 == 0, "a b:c").otherwise("z").alias("p"), F.rand(3).alias("x"))
    rows.where("id < 30000").coalesce(1).write.partitionBy("p").parquet(path)  # a large file per partition
    large = set(glob.glob(f"{path}/*/*.parquet"))
    rows.where("id >= 30000 AND p = 'a b:c'").repartition(9).write.mode("append").partitionBy("p").parquet(path)
    before = bag(spark.read.parquet(path), "id", "p", "x")
    limit = min(os.path.getsize(f) for f in large)
    assert compact_small(spark, path, ["p"], limit) == 9
    after = set(glob.glob(f"{path}/*/*.parquet"))
    assert large <= after and len(after) < len(large) + 4
    spark.catalog.refreshByPath(path)
    assert bag(spark.read.parquet(path), "id", "p", "x") == before
    assert compact_small(spark, path, ["p"], 10) == 0


def test_join_is_left_out_only_where_it_changes_nothing(spark):
    left = spark.createDataFrame([(1, "x"), (2, "y"), (1, "z")], "k long, v string")
    text = lambda df: df._jdf.queryExecution().executedPlan().toString()
    for keys, joined in (([1, 2, 3], False), ([1], True), ([1, 1, 2], True)):
        out = needed_join(left, spark.createDataFrame([(k,) for k in keys], "k long"), ["k"])
        assert ("Join" in text(out)) == joined
        assert bag(out, "k", "v") == sorted((k, v) for k, v in [(1, "x"), (2, "y"), (1, "z")] for other in keys if other == k)
    assert needed_join(spark.createDataFrame([(None, "n")], "k long, v string"), left.select("k").limit(1), ["k"]).count() == 0
