"""File layout jobs: compact, cluster, and report files."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.sources.sinks import materialised, release


def files(df: DataFrame) -> DataFrame:
    """Path, bytes and rows of each file behind a file-backed frame."""
    meta = df.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes"))
    return meta.groupBy("path", "bytes").agg(F.count("*").alias("n_rows"))


def file_detail(df: DataFrame) -> DataFrame:
    """One row: number of files, bytes, rows."""
    return files(df).agg(
        F.count("*").alias("n_files"), F.sum("bytes").alias("bytes"), F.sum("n_rows").alias("n_rows")
    )


def compact(
    spark: SparkSession,
    source: str,
    target: str,
    where: Column | None = None,
    file_bytes: int = 128 << 20,
) -> None:
    """Rewrite a table in files of about ``file_bytes``; with ``where``, only the rows it selects.

    The number of files comes from the bytes on disk and the rows rewritten; other rows are copied
    in the files they come in, so ``target`` is always the whole table. Readers of the old folder
    are not disturbed.
    """
    df = spark.read.parquet(source)
    rest = None
    if where is not None:
        inside = F.coalesce(where, F.lit(False))
        df, rest = df.where(inside), df.where(~inside)
    whole = file_detail(spark.read.parquet(source)).first()
    kept = df.count() if where is not None else whole["n_rows"]
    # the share of the bytes on disk that the rewritten rows have
    size = (whole["bytes"] or 0) * kept // max(1, whole["n_rows"])
    df.repartition(max(1, -(-size // file_bytes))).write.mode("overwrite").parquet(target)
    if rest is not None:
        rest.write.mode("append").parquet(target)


def _best_fit(sizes: Sequence[int], capacity: int) -> list[int]:
    """A bin for each size, largest first into the fullest bin that still takes it."""
    room: list[int] = []
    place = [0] * len(sizes)
    for k in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
        open_bins = [b for b, r in enumerate(room) if r >= sizes[k]]
        best = min(open_bins, key=lambda b: room[b]) if open_bins else len(room)
        if best == len(room):
            room.append(capacity)
        room[best] -= sizes[k]
        place[k] = best
    return place


def small_file_bins(df: DataFrame, by: Sequence[str], file_bytes: int) -> DataFrame:
    """Small files worth merging: ``path``, the partition's columns and ``bin`` (a new file of the partition).

    Small is at most half of ``file_bytes``. Files of one partition are packed by size; a file that shares
    its bin with no other is left out. File sizes come from metadata, no column is read.
    """
    listed = df.select(*by, F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes")).distinct()
    small = listed.where(F.col("bytes") <= file_bytes // 2)
    kinds = {f.name: f.dataType.simpleString() for f in small.schema.fields}

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["bytes", "path"], ascending=False)
        part["bin"] = _best_fit(part["bytes"].tolist(), file_bytes)
        return part[part.groupby("bin")["bin"].transform("size") > 1][[*by, "path", "bin"]]

    return small.groupBy(*by).applyInPandas(pack, ", ".join(f"{c} {kinds[c]}" for c in [*by, "path"]) + ", bin int")


def compact_small(spark: SparkSession, path: str, by: Sequence[str], file_bytes: int = 128 << 20) -> int:
    """Merge the small files of a partitioned table in place; returns the number of files merged.

    Only small files are read and replaced, large ones keep their names and are not opened. The merged
    rows are written aside first, then added, and the old files go last: run it while nobody else writes,
    and readers that start between the last two steps see merged rows twice.
    """
    table = spark.read.parquet(path)
    bins = materialised(small_file_bins(table, by, file_bytes), "file-bins")
    old = [r["path"] for r in bins.select("path").collect()]  # names only, as many as the planner lists itself
    if not old:
        return 0
    n_bins = bins.select(*by, "bin").distinct().count()
    files_of = [unquote(name) for name in old]  # metadata spells paths as URIs
    rows = spark.read.schema(table.schema).option("basePath", path).parquet(*files_of)
    rows = rows.withColumn("_path", F.col("_metadata.file_path"))
    dealt = rows.join(bins.select(F.col("path").alias("_path"), F.col("bin").alias("_bin")), "_path").drop("_path")
    staged = materialised(dealt, "compacted")
    # one range of (partition, bin) per task, so a task's file is a bin
    staged.repartitionByRange(n_bins, *by, "_bin").drop("_bin").write.mode("append").partitionBy(*by).parquet(path)
    for name in files_of:
        release(spark, name)
    return len(old)


def _with_rank(df: DataFrame, column: str, bits: int) -> DataFrame:
    """Add ``_r_<column>``: how many of the quantile bounds lie below the value.

    A binary search, one bit per step; each step is a column, so that none is computed twice.
    """
    rank = f"_r_{column}"
    df = df.withColumn(rank, F.lit(0))
    for bit in reversed(range(bits)):
        bound = F.get(F.col("_b")[column], F.col(rank) + ((1 << bit) - 1))
        step = F.when(bound < F.col(column), 1 << bit).otherwise(0)
        df = df.withColumn(rank, F.col(rank) + step)
    return df


def z_value(df: DataFrame, columns: Sequence[str], bits: int = 6) -> DataFrame:
    """Add ``_z``: interleaved bits of each column's quantile rank (2 ** bits ranks per column).

    Ranks from approximate quantiles keep the cells even when values are skewed. The quantiles
    of all columns are one row from one pass, read as a scalar subquery.
    """
    cells = 1 << bits
    points = [i / cells for i in range(1, cells)]
    bounds = df.agg(F.struct(*[F.percentile_approx(c, points).alias(c) for c in columns]).alias("b"))
    out = df.withColumn("_b", bounds.scalar())
    for c in columns:
        out = _with_rank(out, c, bits)
    terms = [
        F.shiftleft(
            F.shiftright(f"_r_{c}", i).bitwiseAND(F.lit(1)).cast("bigint"), i * len(columns) + j
        )
        for j, c in enumerate(columns)
        for i in range(bits)
    ]
    z = reduce(lambda a, b: a.bitwiseOR(b), terms)
    return out.withColumn("_z", z).drop("_b", *[f"_r_{c}" for c in columns])


def clustered(df: DataFrame, columns: Sequence[str], row_id: Sequence[str], n: int, bits: int = 6) -> DataFrame:
    """Rows near each other in all ``columns`` share files, so that min/max skip the rest.

    ``row_id`` follows the z value in the range split: many rows with one z value can then
    still be divided over several files.
    """
    placed = z_value(df, columns, bits)
    return (
        placed.repartitionByRange(n, "_z", *row_id)
        .sortWithinPartitions("_z", *columns)
        .drop("_z")
    )


def files_hit(df: DataFrame, condition: Column) -> DataFrame:
    """Files with at least one row that meets ``condition``."""
    return files(df.where(condition)).select("path", "n_rows")
