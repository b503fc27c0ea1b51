"""Writers, schema checks and reuse of intermediate results."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewheel.functions.sizes import row_bytes
from tidewheel.session import fresh_dir, shared_root


class SchemaMismatch(ValueError):
    """A batch does not fit the table it should be added to."""


def save_table(df: DataFrame, name: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).format("parquet").saveAsTable(name)


def save_bucketed(df: DataFrame, name: str, keys: Sequence[str], n: int) -> None:
    """Table in ``n`` buckets of ``keys``, each sorted by them.

    Tables with the same buckets join on the keys, and aggregate by them, without an exchange. Rows are
    dealt before the write, so that a bucket is one file and not one per task.
    """
    df.repartition(n, *keys).write.mode("overwrite").format("parquet").bucketBy(n, *keys).sortBy(*keys).saveAsTable(name)


def append_files(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], mode: str = "overwrite") -> None:
    """One folder per value of ``by``.

    ``rebalance`` groups each value's rows into few files and still splits a value that is
    too big for one task, so a hot value does not end up in one writer.
    """
    df.hint("rebalance", *by).write.mode(mode).partitionBy(*by).parquet(path)


def replace_slices(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Overwrite only the partitions that ``df`` has rows for."""
    (
        df.hint("rebalance", *by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def run_only(df: DataFrame) -> None:
    """Run the whole plan and keep nothing."""
    df.write.format("noop").mode("overwrite").save()


def check_schema(batch: DataFrame, expected: T.StructType, allow_new: bool = False) -> None:
    """Refuse missing columns, other types and (unless ``allow_new``) unknown columns."""
    have = {f.name: f.dataType for f in batch.schema.fields}
    want = {f.name: f.dataType for f in expected.fields}
    problems = [f"missing {n}" for n in want if n not in have]
    problems += [
        f"{n} is {have[n].simpleString()}, expected {want[n].simpleString()}"
        for n in want
        if n in have and have[n] != want[n]
    ]
    if not allow_new:
        problems += [f"unknown {n}" for n in have if n not in want]
    if problems:
        raise SchemaMismatch("; ".join(problems))


def append_checked(batch: DataFrame, path: str) -> None:
    """Append after the schema check that a plain Parquet append leaves out."""
    target = batch.sparkSession.read.parquet(path).schema
    check_schema(batch, target)
    append_files(batch.select(*target.names), path)


def append_evolving(batch: DataFrame, path: str) -> None:
    """Append a batch that may bring new columns; old rows read them as NULL."""
    known = batch.sparkSession.read.option("mergeSchema", True).parquet(path).schema
    common = T.StructType([f for f in known.fields if f.name in batch.columns])
    check_schema(batch, common, allow_new=True)
    append_files(batch, path)


def read_evolved(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", True).parquet(path)


def stacked(old: DataFrame, new: DataFrame) -> DataFrame:
    """Union by name; a column that one side lacks is NULL there."""
    return old.unionByName(new, allowMissingColumns=True)


def estimate_bytes(df: DataFrame) -> int:
    """Bytes of the whole frame, summed on the executors; one number comes back."""
    return df.agg(F.coalesce(F.sum(row_bytes(df)), F.lit(0))).first()[0]


BROADCAST_LIMIT = 64 << 20


def broadcast_hint(df: DataFrame, limit: int = BROADCAST_LIMIT) -> Callable[[DataFrame], DataFrame]:
    """Broadcast mark for ``df`` and projections of it, if its measured size is within ``limit``.

    Beyond the limit the frames are left as they are, for a shuffle join.
    """
    return F.broadcast if estimate_bytes(df) <= limit else lambda frame: frame


def right_sized(df: DataFrame) -> DataFrame:
    """Files of about the session's advisory partition size, whatever the number of tasks before.

    The rebalance happens after the work, so a scan and its filters keep their width.
    """
    return df.hint("rebalance")


def materialised(df: DataFrame, purpose: str) -> DataFrame:
    """Write once under the shared folder and read back: cuts lineage, survives lost executors."""
    path = fresh_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, path: str) -> None:
    """Delete a folder that no frame reads any more, through Spark's own file system."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


class Scratch:
    """Intermediate tables of a run that are deleted as soon as nothing reads them any more."""

    def __init__(self) -> None:
        self.held: dict[int, tuple[DataFrame, str]] = {}

    def write(self, df: DataFrame, purpose: str) -> DataFrame:
        """Like :func:`materialised`, for a table that :meth:`drop` may delete later."""
        path = fresh_dir(df.sparkSession, purpose)
        df.write.parquet(path)
        read = df.sparkSession.read.schema(df.schema).parquet(path)
        self.held[id(read)] = (read, path)
        return read

    def drop(self, *frames: DataFrame) -> None:
        for frame in frames:
            if id(frame) in self.held:
                read, path = self.held.pop(id(frame))
                release(read.sparkSession, path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder."""
    shared_root(df.sparkSession)
    return df.checkpoint()


def create_database(spark: SparkSession, name: str) -> None:
    """Database whose managed tables live under the shared folder."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{fresh_dir(spark, name)}'")


def create_table(spark: SparkSession, name: str, ddl: str, partition_by: Sequence[str] = ()) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    by = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE {name} ({ddl}) USING parquet{by}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")
