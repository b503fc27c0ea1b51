"""Repeatable samples of an exact size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CELLS = 4  # hexadecimal digits of a digest that name its cell


def exact_sample(df: DataFrame, strata: Sequence[str], key: Column, percent: int) -> DataFrame:
    """In each stratum the ``ceil(n * percent / 100)`` rows with the smallest MD5 of ``key``.

    The same rows in every run, on any layout, and computable elsewhere. ``key`` must tell rows apart. No
    stratum is sorted: rows are counted per cell of the digest (its first digits, 65 536 cells), the cell in
    which the sample ends follows from the running count of cells, and only the rows of that one cell are
    ranked.
    """
    if not strata:
        raise ValueError("name at least one column that tells strata apart")
    marked = df.withColumns({"_md5": F.md5(key.cast("string").cast("binary"))}).withColumn("_cell", F.substring("_md5", 1, CELLS))
    cells = marked.groupBy(*strata, "_cell").agg(F.count("*").alias("_in"))
    by_cell = Window.partitionBy(*strata).orderBy("_cell")
    counted = cells.withColumns(
        {
            "_before": F.coalesce(F.sum("_in").over(by_cell.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
            "_n": F.sum("_in").over(Window.partitionBy(*strata)),
        }
    )
    size = F.floor((F.col("_n") * percent + 99) / 100)
    last = counted.where((F.col("_before") < size) & (size <= F.col("_before") + F.col("_in")))
    last = last.select(
        *[F.col(s).alias(f"_s_{s}") for s in strata], F.col("_cell").alias("_last"), (size - F.col("_before")).alias("_more")
    )
    same = [F.col(s).eqNullSafe(F.col(f"_s_{s}")) for s in strata]
    ends = marked.join(last, same)
    whole = ends.where(F.col("_cell") < F.col("_last"))
    edge = ends.where(F.col("_cell") == F.col("_last"))
    rank = F.row_number().over(Window.partitionBy(*strata, "_cell").orderBy("_md5"))
    edge = edge.withColumn("_rank", rank).where(F.col("_rank") <= F.col("_more"))
    return whole.select(*df.columns).unionByName(edge.select(*df.columns))
