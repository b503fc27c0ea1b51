from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import bag
from tidewheel.operators import layout
from tidewheel.session import fresh_dir
from tidewheel.sources import readers, sinks, snapshots


def pairs(spark, values, schema="k INT, v STRING"):
    return spark.createDataFrame(values, schema)


def test_readers_with_and_without_schema(spark, folder):
    df = pairs(spark, [(1, "a"), (2, None)])
    for fmt, options in (("csv", {"header": True}), ("json", {}), ("parquet", {})):
        path = f"{folder}/{fmt}"
        df.write.format(fmt).options(**options).save(path)
        assert bag(readers.read_files(spark, path, fmt, "k INT, v STRING", **options)) == [(1, "a"), (2, None)]
    inferred = readers.read_files(spark, f"{folder}/csv", "csv", header=True)
    assert dict(inferred.dtypes) == {"k": "int", "v": "string"}


def test_generated_rows(spark):
    df = readers.generated(spark, 10, {"m": F.col("id") % 3, "r": F.rand(1)})
    assert [r[1] for r in bag(df, "id", "m")] == [i % 3 for i in range(10)]
    assert bag(df, "r") == bag(df, "r")


def test_schema_is_enforced(spark, folder):
    sinks.append_files(pairs(spark, [(1, "a")]), folder)
    with pytest.raises(sinks.SchemaMismatch, match="k is string"):
        sinks.append_checked(pairs(spark, [("1", "a")], "k STRING, v STRING"), folder)
    with pytest.raises(sinks.SchemaMismatch, match="missing v"):
        sinks.append_checked(pairs(spark, [(1,)], "k INT"), folder)
    with pytest.raises(sinks.SchemaMismatch, match="unknown w"):
        sinks.append_checked(pairs(spark, [(1, "a", 1)], "k INT, v STRING, w INT"), folder)
    sinks.append_checked(pairs(spark, [("b", 2)], "v STRING, k INT"), folder)
    assert bag(spark.read.parquet(folder)) == [(1, "a"), (2, "b")]


def test_schema_evolves_by_new_columns_only(spark, folder):
    sinks.append_files(pairs(spark, [(1, "a")]), folder)
    sinks.append_evolving(pairs(spark, [(2, "b", 5)], "k INT, v STRING, w INT"), folder)
    with pytest.raises(sinks.SchemaMismatch):
        sinks.append_evolving(pairs(spark, [(3, 7)], "k INT, v INT"), folder)
    # A rename looks like one column gone and one new.
    sinks.append_evolving(pairs(spark, [(3, "c")], "k INT, vv STRING"), folder)
    out = sinks.read_evolved(spark, folder)
    assert bag(out, "k", "v", "w", "vv") == [(1, "a", None, None), (2, "b", 5, None), (3, None, None, "c")]
    assert bag(sinks.stacked(pairs(spark, [(1, "a")]), pairs(spark, [(2, 9)], "k INT, w INT")), "k", "w") == [(1, None), (2, 9)]


def test_slices_are_replaced_alone(spark, folder):
    df = pairs(spark, [(1, "a"), (2, "b"), (3, "b")])
    sinks.write_partitioned(df, folder, ["v"])
    sinks.replace_slices(pairs(spark, [(9, "b")]), folder, ["v"])
    assert bag(spark.read.parquet(folder), "k", "v") == [(1, "a"), (9, "b")]


def test_right_size_and_estimate(spark):
    df = spark.range(1000).repartition(20).where("id % 2 = 0")
    sized = sinks.right_sized(df)
    assert sized._jdf.rdd().getNumPartitions() == 1 and sized.count() == 500
    # the work itself keeps its twenty tasks: only the rows that come out are dealt again
    assert "RebalancePartitions" in sized._jdf.queryExecution().optimizedPlan().toString()
    wide = spark.range(10).select(F.repeat(F.lit("x"), 1000).alias("s"))
    assert 10_000 < sinks.estimate_bytes(wide) < 11_000
    assert sinks.estimate_bytes(wide.limit(0)) == 0


def test_reuse(spark):
    df = spark.range(5).withColumn("r", F.rand())
    kept = sinks.materialised(df, "reuse")
    assert bag(kept) == bag(kept)
    cut = sinks.cut_lineage(spark.range(3).groupBy("id").count())
    assert "Aggregate" not in cut._jdf.queryExecution().analyzed().toString()
    cached = spark.range(4).persist()
    assert cached.count() == 4 and cached.storageLevel.useMemory
    cached.unpersist()
    sinks.run_only(df)


def test_tables(spark):
    sinks.create_database(spark, "tidewheel_test")
    name = "tidewheel_test.t"
    sinks.create_table(spark, name, "k INT, v STRING")
    sinks.save_table(pairs(spark, [(1, "a")]), name, "append")
    sinks.save_table(pairs(spark, [(2, "b")]), name, "append")
    assert spark.table(name).count() == 2
    with pytest.raises(Exception, match="(?i)schema|column|cast|type"):
        sinks.save_table(pairs(spark, [(1, "a", 1)], "k INT, v STRING, w INT"), name, "append")
    sinks.drop_table(spark, name)
    assert not spark.catalog.tableExists(name)


def test_versions(spark, folder):
    day = dt.timedelta(days=1)
    start = dt.datetime(2024, 1, 1)
    snapshots.write_version(pairs(spark, [(1, "a")]), folder, 0, "load", start)
    snapshots.write_version(pairs(spark, [(1, "b")]), folder, 1, "update", start + day)
    assert bag(snapshots.read_as_of(spark, folder, start + day / 2)) == [(1, "a")]
    assert bag(snapshots.read_as_of(spark, folder, start + day)) == [(1, "b")]
    with pytest.raises(ValueError):
        snapshots.read_as_of(spark, folder, start - day)
    assert snapshots.restore(spark, folder, 0, start + 2 * day) == 2
    assert bag(snapshots.read_version(spark, folder, 2)) == [(1, "a")]
    assert bag(snapshots.versions(spark, folder), "version", "operation") == [(0, "load"), (1, "update"), (2, "restore 0")]
    assert bag(snapshots.expired_versions(spark, folder, start + 8.5 * day, 7 * day), "version") == [(0,)]
    assert bag(snapshots.expired_versions(spark, folder, start + 90 * day, 7 * day), "version") == [(0,), (1,)]


def test_compaction_and_clustering(spark, folder):
    grid = spark.range(4096).select("id", (F.col("id") % 64).alias("x"), F.floor(F.col("id") / 64).alias("y"))
    grid.repartition(30).write.parquet(f"{folder}/many")
    layout.compact(spark, f"{folder}/many", f"{folder}/one")
    one = spark.read.parquet(f"{folder}/one")
    assert layout.file_detail(one).first()["n_files"] == 1
    assert bag(one, "id") == bag(grid, "id")
    layout.clustered(grid, ["x", "y"], ["id"], 16).write.parquet(f"{folder}/z")
    z = spark.read.parquet(f"{folder}/z")
    assert bag(z, "id", "x", "y") == bag(grid, "id", "x", "y")
    corner = (F.col("x") < 8) & (F.col("y") < 8)
    spread = spark.read.parquet(f"{folder}/many")
    assert layout.files_hit(z, corner).count() <= 2 < layout.files_hit(spread, corner).count()


def test_one_cell_is_still_divided(spark):
    same = spark.range(10_000).withColumn("x", F.lit(1))
    sizes = layout.clustered(same, ["x"], ["id"], 8).groupBy(F.spark_partition_id()).count()
    assert sizes.count() >= 7 and sizes.agg(F.max("count")).first()[0] < 3_000


def test_shared_folder_comes_from_the_session(spark):
    assert fresh_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
