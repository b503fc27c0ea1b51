"""Text clean-up expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean(col: str | Column) -> Column:
    """Lower case without leading and trailing spaces."""
    return F.lower(F.trim(col))


def clean_any_space(col: str | Column) -> Column:
    """Lower case without any leading or trailing white space, tabs and newlines included."""
    return F.lower(F.regexp_replace(col, r"^\s+|\s+$", ""))


def squeezed(col: str | Column) -> Column:
    """Letters and digits only, lower case, single spaces: equal for texts that differ in layout."""
    plain = F.regexp_replace(F.lower(col), r"[^\p{L}\p{N}]+", " ")
    return F.trim(plain)


def text_key(col: str | Column) -> Column:
    """Fixed-width key of the squeezed text, so that long texts are not shuffled."""
    return F.sha2(squeezed(col), 256)
