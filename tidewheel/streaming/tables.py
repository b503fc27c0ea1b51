"""Stream sinks that keep a table: late rows aside, and upserts into hashed folders."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.operators.windows import latest
from tidewheel.sources.sinks import release


def split_late(root: str, at: str, tolerance: int) -> Callable[[DataFrame, int], None]:
    """Sink that keeps rows on time and late rows apart instead of losing the late ones.

    A row is late if it is more than ``tolerance`` seconds behind the newest event of all earlier
    micro-batches (of the earlier ones, so that the order of rows within a batch plays no part); a row
    without a time is late. Rows land in ``rows/batch_id=<n>/is_late=<bool>``, the newest time of each
    batch in ``marks/batch_id=<n>``. A batch that runs again reads the marks of earlier batches only and
    overwrites its own folders, so every row ends up in one of the two outputs exactly once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        newest = None
        if batch_id:
            marks = spark.read.schema(f"batch_id BIGINT, newest {batch.schema[at].dataType.simpleString()}").parquet(f"{root}/marks")
            newest = marks.where(F.col("batch_id") < batch_id).agg(F.max("newest")).first()[0]
        oldest = F.lit(newest) - F.make_interval(secs=F.lit(tolerance))
        late = F.lit(False) if newest is None else F.col(at) < oldest
        rows = f"{root}/rows/batch_id={batch_id}"
        split = batch.withColumn("is_late", F.coalesce(late, F.lit(True)) | F.col(at).isNull())
        split.write.mode("overwrite").partitionBy("is_late").parquet(rows)
        written = spark.read.schema(batch.schema).parquet(rows)
        written.agg(F.max(at).alias("newest")).write.mode("overwrite").parquet(f"{root}/marks/batch_id={batch_id}")

    return write


def split_rows(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """All rows of :func:`split_late` with ``batch_id`` and ``is_late``."""
    return spark.read.schema(f"{schema}, batch_id BIGINT, is_late BOOLEAN").option("basePath", f"{root}/rows").parquet(f"{root}/rows")


def merge_into_buckets(
    root: str, keys: Sequence[str], newest: tuple[str, str], n: int = 64
) -> Callable[[DataFrame, int], None]:
    """Sink that keeps the newest row per key and touches only the buckets its micro-batch touches.

    Keys are hashed into ``n`` buckets; a bucket's rows lie in ``data/batch_id=<b>/bucket=<k>``, written by
    the last batch that touched it. ``index/batch_id=<b>`` says after each batch which folder holds each
    bucket (at most ``n`` rows). Batch b starts from the index of the batch before it, which stays until
    b + 1 has been written: a batch that runs again gives the same table. Folders of the index before these
    two that neither of them names are deleted. ``newest`` = (time, tie) also decides between a batch row and an older row
    of the table, so late rows do not overwrite newer ones.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = _index(spark, root, batch_id - 1)
        placed = batch.where(reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys)))
        placed = latest(placed, keys, *newest).withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int"))
        arrived = f"{root}/arrived/batch_id={batch_id}"
        placed.write.mode("overwrite").partitionBy("bucket").parquet(arrived)  # the batch is run once
        columns = [*batch.columns, "bucket"]
        fresh = spark.read.schema(placed.schema).option("basePath", arrived).parquet(arrived).select(*columns)
        touched = [r[0] for r in fresh.select("bucket").distinct().collect()]
        old = {k: b for k, b in before.items() if k in touched}
        merged = fresh
        if old:
            merged = fresh.unionByName(_read(spark, root, old).where(F.col("bucket").isin(list(old))).select(*columns))
        merged = latest(merged, [*keys, "bucket"], *newest)
        merged.write.mode("overwrite").partitionBy("bucket").parquet(f"{root}/data/batch_id={batch_id}")
        after = before | {k: batch_id for k in touched}
        rows = spark.createDataFrame(sorted(after.items()), "bucket INT, held BIGINT")
        rows.coalesce(1).write.mode("overwrite").parquet(f"{root}/index/batch_id={batch_id}")
        release(spark, arrived)
        for bucket, held in _index(spark, root, batch_id - 2).items():
            if held not in (before.get(bucket), after.get(bucket)):
                release(spark, f"{root}/data/batch_id={held}/bucket={bucket}")
        release(spark, f"{root}/index/batch_id={batch_id - 3}")

    return merge


def _index(spark: SparkSession, root: str, batch_id: int) -> dict[int, int]:
    """Bucket to the batch whose folder holds it; at most one entry per bucket."""
    if batch_id < 0:
        return {}
    rows = spark.read.schema("bucket INT, held BIGINT").parquet(f"{root}/index/batch_id={batch_id}")
    return {r["bucket"]: r["held"] for r in rows.collect()}


def _read(spark: SparkSession, root: str, held: dict[int, int]) -> DataFrame:
    by_batch: dict[int, list[int]] = {}
    for bucket, batch_id in held.items():
        by_batch.setdefault(batch_id, []).append(bucket)
    named: Column = reduce(
        lambda a, b: a | b, ((F.col("batch_id") == b) & F.col("bucket").isin(ks) for b, ks in sorted(by_batch.items()))
    )
    return spark.read.option("basePath", f"{root}/data").parquet(f"{root}/data").where(named).drop("batch_id")


def read_buckets(spark: SparkSession, root: str) -> DataFrame:
    """The table as of the last batch; the filter on folders is settled while planning."""
    listed = spark.read.option("basePath", f"{root}/index").parquet(f"{root}/index")
    last = listed.agg(F.max("batch_id")).first()[0]
    return _read(spark, root, _index(spark, root, last)).drop("bucket")
