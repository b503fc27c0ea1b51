"""Distinct counts and quantiles from stored sketches.

One row per day (or other unit) holds a HyperLogLog sketch of an item, a KLL sketch of a number and the
number of rows. Any span of units is answered from these rows alone: sketches merge, the rows they were
made from are not read again. Sketches are built in each task before the shuffle, so a unit with most
of the rows costs one sketch per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_SLOTS = 12
#: Three standard errors of 2 ** LG_SLOTS slots.
DISTINCT_BOUND = 3 * 1.04 / 2 ** (LG_SLOTS / 2)
KLL_K = 200
#: Rank error of a KLL sketch of this size that is exceeded in one per cent of cases, doubled.
RANK_BOUND = 0.0266


def unit_sketches(df: DataFrame, unit: Column, item: str, value: str) -> DataFrame:
    """One row per unit: ``unit``, ``n_rows``, ``items`` and ``numbers`` (sketches; NULLs are left out)."""
    return df.groupBy(unit.alias("unit")).agg(
        F.count("*").alias("n_rows"),
        F.hll_sketch_agg(item, LG_SLOTS).alias("items"),
        F.kll_sketch_agg_double(F.col(value).cast("double"), KLL_K).alias("numbers"),
    )


def merged_sketches(sketches: DataFrame, span: Column, rank: float = 0.5) -> DataFrame:
    """Per ``span`` (an expression over ``unit``): units and rows merged, distinct items, the quantile at ``rank``."""
    merged = sketches.groupBy(span.alias("span")).agg(
        F.count("*").alias("n_units"), F.sum("n_rows").alias("n_rows"),
        F.hll_union_agg("items").alias("items"), F.kll_merge_agg_double("numbers").alias("numbers"),
    )
    return merged.select(
        "span", "n_units", "n_rows", F.hll_sketch_estimate("items").alias("distinct"),
        F.kll_sketch_get_quantile_double("numbers", F.lit(rank)).alias("quantile"),
    )
