"""Slowly changing dimensions. Validity is half-open: ``effective_from <= d < effective_to``."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.operators.upserts import insert_new, upsert
from tidewheel.operators.windows import HOT_ROWS, carried
from tidewheel.sources.sinks import broadcast_hint


def keep_first(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """SCD0: a value never changes once it is stored."""
    return insert_new(target, batch, keys)


def overwrite(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """SCD1: only the newest value is stored."""
    return upsert(target, batch, keys)


def keep_previous(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], tracked: str, previous: str
) -> DataFrame:
    """SCD3: ``previous`` takes the old value of ``tracked`` when it changes."""
    moved = ~F.col(f"t.{tracked}").eqNullSafe(F.col(f"s.{tracked}"))
    update = {c: F.col(f"s.{c}") for c in batch.columns if c not in keys}
    update[previous] = F.when(moved, F.col(f"t.{tracked}")).otherwise(F.col(f"t.{previous}"))
    return upsert(target, batch, keys, update=update)


def load_history(
    history: DataFrame, batch: DataFrame, keys: Sequence[str], tracked: Sequence[str]
) -> DataFrame:
    """SCD2 in one pass over the open rows; closed rows pass through without a shuffle.

    ``batch`` has one row per key with ``effective_from``. A key whose tracked values all
    compare equal (NULL equals NULL) is left alone, so a batch can be loaded again. A change
    dated on the open row's own first day corrects that row; an older one changes nothing.
    """
    columns = [*keys, *tracked, "effective_from", "effective_to", "is_current"]
    closed = history.where(~F.col("is_current"))
    open_rows = history.where("is_current")
    hint = broadcast_hint(batch)
    incoming = batch.select(*keys, F.struct(*tracked, "effective_from").alias("b"))
    joined = open_rows.select(*keys, F.struct(*columns).alias("o")).join(
        hint(incoming), list(keys), "left"
    )
    differs = reduce(
        lambda a, b: a | b, (~F.col(f"o.{c}").eqNullSafe(F.col(f"b.{c}")) for c in tracked)
    )
    changed = F.col("b").isNotNull() & differs
    begins, starts = F.col("b.effective_from"), F.col("o.effective_from")
    to_type = history.schema["effective_to"].dataType

    def version(attrs: str, from_: Column, to: Column, current: bool) -> Column:
        return F.struct(
            *[F.col(k).alias(k) for k in keys],
            *[F.col(f"{attrs}.{c}").cast(history.schema[c].dataType).alias(c) for c in tracked],
            from_.cast(history.schema["effective_from"].dataType).alias("effective_from"),
            to.cast(to_type).alias("effective_to"),
            F.lit(current).alias("is_current"),
        )

    none = F.lit(None)
    stays = F.array(version("o", starts, none, True))
    corrected = F.array(version("b", starts, none, True))
    split = F.array(version("o", starts, begins, False), version("b", begins, none, True))
    versions = (
        F.when(changed & (begins > starts), split)
        .when(changed & (begins == starts), corrected)
        .otherwise(stays)
    )
    carried_on = joined.select(F.explode(versions).alias("v")).select("v.*")
    known = open_rows.select(*keys).join(hint(batch.select(*keys)), list(keys), "left_semi")
    fresh = batch.join(known, list(keys), "left_anti").select(
        *keys,
        *tracked,
        "effective_from",
        F.lit(None).cast(to_type).alias("effective_to"),
        F.lit(True).alias("is_current"),
    )
    return closed.select(*columns).unionByName(carried_on).unionByName(fresh)


def as_of(history: DataFrame, day: Column) -> DataFrame:
    """The rows that were valid on ``day``."""
    still = F.col("effective_to").isNull() | (day < F.col("effective_to"))
    return history.where((F.col("effective_from") <= day) & still)


def version_at(
    facts: DataFrame,
    history: DataFrame,
    keys: Sequence[str],
    at: str,
    row_id: str,
    attrs: Sequence[str],
    slice_by: Column,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """For each fact the attributes that were valid at its time; NULL where none was.

    Versions and facts are merged in time order and the newest version is carried forward.
    A range join would pair every fact of a key with every version of it.
    """
    payload = F.struct(*attrs, "effective_to")
    events = history.select(
        *keys, F.col("effective_from").cast(facts.schema[at].dataType).alias(at), payload.alias("_version")
    ).withColumn("_kind", F.lit(0))
    both = facts.withColumn("_kind", F.lit(1)).unionByName(events, allowMissingColumns=True)
    order = [at, "_kind", row_id]
    newest = {"_valid": F.col("_version")}
    seen = carried(both, keys, order, slice_by, newest, hot_rows=hot_rows)
    ended = F.col(at) >= F.col("_valid.effective_to")
    return (
        seen.where("_kind = 1")
        .withColumns({a: F.when(~F.coalesce(ended, F.lit(False)), F.col(f"_valid.{a}")) for a in attrs})
        .drop("_kind", "_version", "_valid")
    )
