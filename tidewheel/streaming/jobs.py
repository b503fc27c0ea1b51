"""Running streams over files: all that is there now, restartable, with repeatable sinks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewheel.operators.upserts import upsert
from tidewheel.operators.windows import top_n
from tidewheel.session import fresh_dir


def drain(
    stream: DataFrame,
    on_batch: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
) -> None:
    """Process everything available and stop. The same checkpoint goes on where it ended."""
    query = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(on_batch)
        .start()
    )
    query.awaitTermination()


def to_batch_folders(path: str) -> Callable[[DataFrame, int], None]:
    """Sink with one folder per micro-batch; a repeated batch overwrites its own folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def drained(stream: DataFrame, purpose: str, mode: str = "append") -> DataFrame:
    """Run ``stream`` once over what is there and return all rows it emitted, with ``batch_id``."""
    spark = stream.sparkSession
    out = fresh_dir(spark, purpose)
    drain(stream, to_batch_folders(f"{out}/rows"), f"{out}/checkpoint", mode)
    schema = T.StructType([*stream.schema.fields, T.StructField("batch_id", T.LongType())])
    return spark.read.schema(schema).parquet(f"{out}/rows")


def newest_state(emitted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Last row per key of an update-mode stream."""
    return top_n(emitted, keys, [F.desc("batch_id")], 1).drop("batch_id")


def ingest_files(spark: SparkSession, source: DataFrame, target: str, checkpoint: str) -> None:
    """Land new files as they are, once each."""
    query = (
        source.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def merge_into_versions(
    root: str, keys: Sequence[str], newest: tuple[str, str]
) -> Callable[[DataFrame, int], None]:
    """Sink that merges each micro-batch into version ``batch_id`` of a table under ``root``.

    Version n is built from version n - 1, so a batch that runs twice gives the same version.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch_id == 0:
            before = spark.createDataFrame([], batch.schema)
        else:
            before = spark.read.schema(batch.schema).parquet(f"{root}/v={batch_id - 1}")
        after = upsert(before, batch, keys, newest=newest)
        after.write.mode("overwrite").parquet(f"{root}/v={batch_id}")

    return merge
