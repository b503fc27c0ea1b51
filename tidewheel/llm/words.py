"""Words of a text as Spark expressions, and small helpers the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    """Runs of other than the six ASCII space characters, in order; no words for NULL."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE, -1), lambda w: w != "")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def total(array: Column) -> Column:
    return F.aggregate(array, F.lit(0).cast("long"), lambda a, x: a + x)


def set_aside(docs: DataFrame, *read: str) -> DataFrame:
    """The columns ``read``, and all others in the struct ``_own``: there no name meets one that an operator adds."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in read]
    return docs.select(*read, F.struct(*(others or [F.lit(0)])).alias("_own"))


def brought_back(columns: list[str], **new: Column) -> list[Column]:
    """``columns`` out of a frame of :func:`set_aside`; those in ``new`` are given as they come out."""
    return [new.get(c, F.col("_own")[c]).alias(c) for c in columns]


def has_column(df: DataFrame, *names: str) -> None:
    """Refuse a frame that lacks a column the operator reads."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
