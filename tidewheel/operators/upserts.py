"""Merges on plain Parquet: each takes the table and a batch and returns the next table.

A batch is usually far smaller than its table, so no form shuffles the table for a small batch:
the table meets the batch in a left join whose batch side is broadcast if its measured size allows,
and new keys are found against the few table keys that the batch touches. A big batch gets shuffle
joins, with skewed partitions split by adaptive execution.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewheel.operators.windows import latest
from tidewheel.sources.sinks import broadcast_hint, materialised, replace_slices


def _has_key(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys))


def _new_keys(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    hint: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Rows of ``source`` whose key the target lacks. Only target keys are read for it."""
    wanted = hint(source.select(*keys))
    known = target.select(*keys).join(wanted, list(keys), "left_semi").distinct()
    return source.join(known, list(keys), "left_anti")


def one_per_key(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``batch``, with a check inside the plan that no key occurs twice."""
    twice = F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(1))) > 1
    message = F.concat(F.lit("merge batch repeats a key: "), F.to_json(F.struct(*keys)))
    return batch.withColumn("_once", F.when(twice, F.raise_error(message).cast("int"))).where("_once IS NULL").drop("_once")


def _boxed(df: DataFrame, keys: Sequence[str], box: str) -> DataFrame:
    return df.select(*keys, F.struct(*df.columns).alias(box))


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: dict[str, Column] | None = None,
    newest: tuple[str, str] | None = None,
    insert: bool = True,
    delete_when: Column | None = None,
    insert_when: Column | None = None,
) -> DataFrame:
    """Matched rows are updated, unmatched source rows inserted.

    ``update`` maps columns to expressions over the structs ``t`` (table row) and ``s`` (batch
    row); without it all columns are taken from the batch. ``newest`` = (time, tie) keeps one
    batch row per key, otherwise the batch must have unique keys. ``delete_when`` is a condition
    over ``t`` and ``s`` on matched rows, ``insert_when`` one over the columns of new batch rows.
    A NULL key matches nothing.
    """
    keyed = source.where(_has_key(keys))
    keyed = latest(keyed, keys, *newest) if newest else one_per_key(keyed, keys)
    # The batch is read three times below: checked and written once, it is also free of the check's shuffle.
    batch = materialised(keyed, "merge-batch")
    source = batch.unionByName(source.where(~_has_key(keys)))
    columns = target.columns
    hint = broadcast_hint(batch)
    joined = _boxed(target.where(_has_key(keys)), keys, "t").join(
        hint(_boxed(batch, keys, "s")), list(keys), "left"
    )
    matched = F.col("s").isNotNull()
    if delete_when is not None:
        joined = joined.where(~matched | ~F.coalesce(delete_when, F.lit(False)))
    if update is None:
        update = {c: F.col(f"s.{c}") for c in columns if c in source.columns and c not in keys}
    kept = joined.select(
        *[
            (F.when(matched, update[c]).otherwise(F.col(f"t.{c}")) if c in update else F.col(f"t.{c}"))
            .cast(target.schema[c].dataType)
            .alias(c)
            for c in columns
        ]
    )
    parts = [kept, target.where(~_has_key(keys))]
    if insert:
        fresh = _new_keys(target, batch, keys, hint).unionByName(source.where(~_has_key(keys)))
        if insert_when is not None:
            fresh = fresh.where(insert_when)
        lacking = [F.lit(None).cast(target.schema[c].dataType).alias(c) for c in columns if c not in fresh.columns]
        parts.append(fresh.select("*", *lacking).select(*columns))
    return reduce(DataFrame.unionByName, parts)


def insert_new(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Insert-only merge: existing rows never change."""
    batch = source.where(_has_key(keys))
    fresh = _new_keys(target, batch, keys, broadcast_hint(batch.select(*keys)))
    return target.unionByName(fresh).unionByName(source.where(~_has_key(keys)))


def update_where(df: DataFrame, condition: Column, changes: dict[str, Column]) -> DataFrame:
    """Conditional update in place of ``UPDATE ... SET ... WHERE``."""
    return df.withColumns(
        {c: F.when(condition, expr).otherwise(F.col(c)) for c, expr in changes.items()}
    )


def apply_changes(
    target: DataFrame, changes: DataFrame, keys: Sequence[str], at: str, tie: str
) -> DataFrame:
    """Replay insert/update/delete events (``op`` = I, U, D) up to the current state.

    The newest event per key decides; a deleted key that comes back is an insert again.
    """
    return upsert(
        target,
        changes,
        keys,
        newest=(at, tie),
        delete_when=F.col("s.op") == "D",
        insert_when=F.col("op") != "D",
    )


def after_images(log: DataFrame, after: str, op: str, at: str, tie: str, keys: Sequence[str], before: str) -> DataFrame:
    """Change events from a log with before and after row images.

    A delete has no after image, so its key comes from the before image.
    """
    names = log.schema[after].dataType.names
    return log.select(
        *[
            (F.coalesce(f"{after}.{c}", f"{before}.{c}") if c in keys else F.col(f"{after}.{c}")).alias(c)
            for c in names
        ],
        F.col(op).alias("op"),
        at,
        tie,
    )


def change_feed(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that differ between two versions, with ``change_type`` insert, update or delete.

    Rows with a NULL key match nothing: they skip the join, where they would meet in one task.
    """
    values = [c for c in new.columns if c not in keys]
    joined = _boxed(old.where(_has_key(keys)), keys, "o").join(
        _boxed(new.where(_has_key(keys)), keys, "n"), list(keys), "full_outer"
    )
    same = reduce(
        lambda a, b: a & b,
        (F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}")) for c in values),
        F.lit(True),
    )
    kind = (
        F.when(F.col("o").isNull(), "insert")
        .when(F.col("n").isNull(), "delete")
        .when(~same, "update")
    )
    changed = (
        joined.withColumn("change_type", kind)
        .where(F.col("change_type").isNotNull())
        .select(
            *keys,
            *[F.coalesce(F.col("n"), F.col("o"))[c].alias(c) for c in values],
            "change_type",
        )
    )
    for side, name in ((old, "delete"), (new, "insert")):
        keyless = side.where(~_has_key(keys)).withColumn("change_type", F.lit(name))
        changed = changed.unionByName(keyless)
    return changed


def _in_partitions(target: DataFrame, touched: DataFrame, part: str) -> DataFrame:
    """Rows of the listed partitions; NULL is a partition like others. Equality keeps the pruning."""
    out = target.join(touched.where(F.col(part).isNotNull()), part, "left_semi")
    if touched.where(F.col(part).isNull()).isEmpty():
        return out
    return out.unionByName(target.where(F.col(part).isNull()))


def upsert_partitions(
    spark: SparkSession, table: str, source: DataFrame, keys: Sequence[str], part: str
) -> None:
    """Merge into a partitioned catalog table and rewrite only the partitions it touches.

    Touched are the partitions of the batch and those where a batch key lies today, so a key
    whose partition value moved is updated, not inserted twice; NULL is a partition like others.
    The new content is written to the shared folder first and then replaces its partitions; only
    after that are partitions dropped that have no row left. A job that dies in between leaves a
    key in its old and its new partition at worst, and running it again mends that.
    """
    target = spark.table(table)
    home = target.select(part, *keys).join(source.where(_has_key(keys)).select(*keys), list(keys), "left_semi")
    # Partition values are folder names: metadata-sized, whatever the table holds.
    touched = materialised(home.select(part).union(source.select(part)).distinct(), "touched")
    after = materialised(upsert(_in_partitions(target, touched, part), source, keys), "merge")
    emptied = [row[0] for row in touched.subtract(after.select(part)).toLocalIterator()]
    folder = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").first()[1]
    replace_slices(after, folder, [part])
    spark.sql(f"MSCK REPAIR TABLE {table}")
    after.createOrReplaceTempView("tidewheel_merge")
    others = ", ".join(c for c in target.columns if c != part)
    for value in emptied:  # emptied first: dropping leaves the files of an external table
        spec = f"PARTITION ({part} = {'NULL' if value is None else repr(str(value))})"
        if value is None:  # no statement can overwrite the NULL partition of a numeric column
            path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{part}=__HIVE_DEFAULT_PARTITION__")
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        else:
            spark.sql(f"INSERT OVERWRITE TABLE {table} {spec} SELECT {others} FROM tidewheel_merge WHERE false")
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {spec}")
    spark.catalog.refreshTable(table)
