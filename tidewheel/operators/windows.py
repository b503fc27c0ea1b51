"""Ordered computations over groups that may be very large.

A plain window puts a whole key in one task. That is fine for most keys and fatal for a key with
a third of all rows. Here the rows per key are counted first. Keys below ``hot_rows`` get the
plain window. The order column of the others is cut into slices: each (key, slice) is a window
of its own, and what the earlier slices contribute arrives as one *seed row* at the head of the
slice. Seeds come from an aggregate per (hot key, slice), which combines before its shuffle.

``slice_by`` must never fall when the order columns rise, and rows that compare equal must share
a slice. It is only applied to hot keys, so it can be fine: choose it so that the busiest key has
at most some million rows in a slice. Order columns must be unique within a key where a function
counts rows.

A key is hot from ``hot_rows`` rows on or, on very large inputs, from a millionth of all rows on.
The broadcast list of hot keys therefore never exceeds a million keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewheel.operators.skew import flag_hot

HOT_ROWS = 1_000_000
HOT_SHARE = 1e-6


def _ordered(order: Sequence[str], backwards: bool) -> list[Column]:
    return [F.col(c).desc() if backwards else F.col(c).asc() for c in order]


def _sliced(df: DataFrame, keys: Sequence[str], slice_by: Column, hot_rows: int) -> DataFrame:
    """Add ``_hot`` and ``_slice``; a key that is not hot is one slice."""
    return _flagged(df, keys, hot_rows).withColumn("_slice", F.when(F.col("_hot"), slice_by))


def _flagged(df: DataFrame, keys: Sequence[str], hot_rows: int) -> DataFrame:
    """Add ``_hot``, unless an earlier step of the same work has done so."""
    if "_hot" in df.columns:
        return df
    return flag_hot(df, keys, HOT_SHARE, hot_rows, "_hot")


def _groups(keys: Sequence[str]) -> WindowSpec:
    """One window per (key, slice). ``_hot`` follows from the key; naming it lets a later filter
    on hot rows pass below the window."""
    return Window.partitionBy(*keys, "_hot", "_slice")


def _without(df: DataFrame, given: DataFrame, *columns: str) -> DataFrame:
    """Drop helper columns, but leave a ``_hot`` that came with the input."""
    return df.drop(*[c for c in columns if c not in given.columns])


def _with_seeds(sliced: DataFrame, seeds: DataFrame) -> DataFrame:
    """Data rows (``_seq`` 1) with one seed row (``_seq`` 0) per (hot key, slice)."""
    heads = seeds.withColumns({"_seq": F.lit(0), "_hot": F.lit(True)})
    return sliced.withColumn("_seq", F.lit(1)).unionByName(heads, allowMissingColumns=True)


def _earlier(keys: Sequence[str], backwards: bool):
    return (
        Window.partitionBy(*keys)
        .orderBy(*_ordered(["_slice"], backwards))
        .rowsBetween(Window.unboundedPreceding, -1)
    )


def running_sums(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    slice_by: Column,
    sums: dict[str, Column],
    backwards: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Running total per key for each entry of ``sums``, current row included."""
    names = list(sums)
    sliced = _sliced(df, keys, slice_by, hot_rows).withColumns(
        {f"_v_{n}": expr for n, expr in sums.items()}
    )
    per_slice = sliced.where("_hot").groupBy(*keys, "_slice").agg(
        *[F.sum(f"_v_{n}").alias(f"_v_{n}") for n in names]
    )
    before = _earlier(keys, backwards)
    seeds = per_slice.select(
        *keys, "_slice", *[F.sum(f"_v_{n}").over(before).alias(f"_v_{n}") for n in names]
    )
    # A sum may be wider than its input (int to bigint); give both sides one type.
    types = {f.name: f.dataType for f in seeds.schema.fields}
    sliced = sliced.withColumns({f"_v_{n}": F.col(f"_v_{n}").cast(types[f"_v_{n}"]) for n in names})
    w = (
        _groups(keys)
        .orderBy("_seq", *_ordered(order, backwards))
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    out = (
        _with_seeds(sliced, seeds)
        .withColumns({n: F.sum(f"_v_{n}").over(w) for n in names})
        .where("_seq = 1")
    )
    return _without(out, df, "_seq", "_hot", "_slice", *[f"_v_{n}" for n in names])


def carried(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    slice_by: Column,
    values: dict[str, Column],
    include_current: bool = True,
    backwards: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Last non-NULL value of each entry, up to the current row (or the one before it)."""
    names = list(values)
    sliced = _sliced(df, keys, slice_by, hot_rows).withColumns(
        {f"_v_{n}": expr for n, expr in values.items()}
    )
    newest = F.min_by if backwards else F.max_by
    at = F.struct(*order)
    per_slice = sliced.where("_hot").groupBy(*keys, "_slice").agg(
        *[
            newest(F.col(f"_v_{n}"), F.when(F.col(f"_v_{n}").isNotNull(), at)).alias(f"_v_{n}")
            for n in names
        ]
    )
    before = _earlier(keys, backwards)
    seeds = per_slice.select(
        *keys,
        "_slice",
        *[F.last(f"_v_{n}", ignorenulls=True).over(before).alias(f"_v_{n}") for n in names],
    )
    w = (
        _groups(keys)
        .orderBy("_seq", *_ordered(order, backwards))
        .rowsBetween(Window.unboundedPreceding, 0 if include_current else -1)
    )
    out = (
        _with_seeds(sliced, seeds)
        .withColumns({n: F.last(f"_v_{n}", ignorenulls=True).over(w) for n in names})
        .where("_seq = 1")
    )
    return _without(out, df, "_seq", "_hot", "_slice", *[f"_v_{n}" for n in names])


def neighbour(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    slice_by: Column,
    values: dict[str, Column],
    following: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Value of the row before (or after) each row; a NULL neighbour stays NULL."""
    boxed = {name: F.struct(expr.alias("v")) for name, expr in values.items()}
    out = carried(df, keys, order, slice_by, boxed, False, following, hot_rows)
    return out.withColumns({name: F.col(f"{name}.v") for name in values})


def rolling_sums(
    df: DataFrame,
    keys: Sequence[str],
    at: str,
    slice_by: Column,
    value: str,
    reach: int,
    prefix: str = "rolling",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Sum and count of ``value`` over ``[at - reach, at]``, both ends and all ties included.

    Values are added as they are: sums, NaN and large values come out as from a plain window. Keys
    that are not hot get that window. Rows of hot keys are added up per time first, the frames are
    put together from running sums over slices of times, and the rows fetch the result of their
    time. ``slice_by`` is an expression over ``at``, and is also applied to ``at - reach``.
    """
    flagged = _flagged(df, keys, hot_rows)
    w = Window.partitionBy(*keys).orderBy(at).rangeBetween(-reach, 0)
    cold = flagged.where("_hot IS NULL").withColumns(
        {f"{prefix}_n": F.count(value).over(w), f"{prefix}_sum": F.sum(value).over(w).cast("double")}
    )
    busy = flagged.where("_hot")
    per_time = busy.groupBy(*keys, at).agg(F.sum(value).alias("_d"), F.count(value).alias("_c"))
    rolled = _framed(per_time, keys, at, slice_by, reach, prefix)
    names = {c: f"_t_{c}" for c in [*keys, at]}
    rolled = rolled.select(*[F.col(c).alias(n) for c, n in names.items()], f"{prefix}_n", f"{prefix}_sum")
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()))
    hot = busy.join(rolled, same).drop(*names.values())
    return _without(cold.unionByName(hot), df, "_hot")


def rolling_totals(
    df: DataFrame,
    keys: Sequence[str],
    at: str,
    slice_by: Column,
    value: str,
    reach: int,
    prefix: str = "rolling",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """:func:`rolling_sums` with one output row per (key, ``at``).

    Rows of one time are added up before the shuffle, so even a key whose rows all share a few
    times (days, say) costs only its number of times.
    """
    per_time = df.groupBy(*keys, at).agg(F.sum(value).alias("_d"), F.count(value).alias("_c"))
    flagged = _flagged(per_time, keys, hot_rows)
    w = Window.partitionBy(*keys).orderBy(at).rangeBetween(-reach, 0)
    cold = flagged.where("_hot IS NULL").withColumns(_totals(w, prefix))
    hot = _framed(flagged.where("_hot").drop("_hot"), keys, at, slice_by, reach, prefix)
    return cold.drop("_hot", "_d", "_c").unionByName(hot)


def _totals(w: WindowSpec, prefix: str) -> dict[str, Column]:
    return {
        f"{prefix}_n": F.coalesce(F.sum("_c").over(w), F.lit(0)),
        f"{prefix}_sum": F.sum("_d").over(w).cast("double"),
    }


def _block(df: DataFrame, at: str, width: int) -> Column:
    """Number of the ``width``-wide block that ``at`` falls in."""
    if isinstance(df.schema[at].dataType, T.FloatType | T.DoubleType):
        return F.floor(F.col(at) / width)
    # A quotient of whole numbers would be a double, and put large neighbours into one block.
    return F.call_function("div", F.col(at) - F.pmod(at, F.lit(width)), F.lit(width))


def _framed(
    per_time: DataFrame, keys: Sequence[str], at: str, slice_by: Column, reach: int, prefix: str
) -> DataFrame:
    """Frames over one row per time, at a cost in proportion to the times.

    Blocks of time are as wide as ``reach``, so a frame is the end of one block, from ``at - reach`` on,
    and the beginning of the next, up to ``at``. Both are running sums within a block, cut into slices;
    for the first, each time sends a row to where its frame begins. Only values of a frame are added up
    for it. A time that ``reach`` does not move (NULL, NaN, infinite) is a frame of its own.
    """
    n, total = F.col("_c"), F.col("_d")
    if reach:
        begin, parts, lone = F.col(at) - reach, [*keys, "_block"], F.col("_block").isNull()
        block = F.when(begin < F.col(at), _block(per_time, at, reach))
        times = per_time.withColumns({"_hot": F.lit(True), "_block": block, "_given": F.lit(True)})
        upto = running_sums(times, parts, [at], slice_by, {"_c_upto": n, "_d_upto": total})
        begins = upto.select(
            *keys,
            (F.col("_block") - 1).alias("_block"),
            begin.alias(at),
            F.col(at).alias("_of"),
            F.when(lone, n).otherwise(F.col("_c_upto")).alias("_c_upto"),
            F.when(lone, total).otherwise(F.col("_d_upto")).alias("_d_upto"),
            F.lit(True).alias("_hot"),
            F.lit(False).alias("_given"),
        )
        # Going backwards, a time comes before the frames that begin at it.
        since = {"_c_since": F.when(~lone, n), "_d_since": F.when(~lone, total)}
        both = times.unionByName(begins, allowMissingColumns=True)
        both = running_sums(both, parts, [at, "_given"], slice_by, since, backwards=True).where("NOT _given")
        per_time = both.select(*keys, F.col("_of").alias(at), *[
            F.coalesce(F.col(f"_{c}_upto") + F.col(f"_{c}_since"), f"_{c}_upto", f"_{c}_since").alias(f"_{c}") for c in "cd"
        ])
    return per_time.select(*keys, at, n.alias(f"{prefix}_n"), total.cast("double").alias(f"{prefix}_sum"))


def rolling_average(
    df: DataFrame,
    keys: Sequence[str],
    at: str,
    slice_by: Column,
    value: str,
    reach: int,
    name: str,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    out = rolling_sums(df, keys, at, slice_by, value, reach, "_r", hot_rows)
    return out.withColumn(name, F.col("_r_sum") / F.col("_r_n")).drop("_r_sum", "_r_n")


def runs(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    slice_by: Column,
    previous: Column,
    starts: Column,
    name: str,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Number the runs of each key: ``starts`` (over ``_prev`` = ``previous`` one row up) opens one."""
    base = _flagged(df, keys, hot_rows)
    seen = neighbour(base, keys, order, slice_by, {"_prev": previous})
    opened = {name: F.when(starts, 1).otherwise(0)}
    return _without(running_sums(seen, keys, order, slice_by, opened), df, "_prev", "_hot")


def sessions(
    df: DataFrame,
    keys: Sequence[str],
    at: str,
    tie: str,
    slice_by: Column,
    gap: int,
    name: str = "session_id",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Session number per key; more than ``gap`` after the last row opens a new one."""
    opens = F.col("_prev").isNull() | (F.col(at) - F.col("_prev") > gap)
    return runs(df, keys, [at, tie], slice_by, F.col(at), opens, name, hot_rows)


def session_totals(
    df: DataFrame,
    keys: Sequence[str],
    at: str,
    tie: str,
    slice_by: Column,
    gap: int,
    value: str,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """One row per session: its start and the sum of ``value``."""
    numbered = sessions(df, keys, at, tie, slice_by, gap, "_session", hot_rows)
    return (
        numbered.groupBy(*keys, "_session")
        .agg(F.min(at).alias("session_start"), F.sum(value).alias("amount"))
        .drop("_session")
    )


def ranks(
    df: DataFrame,
    keys: Sequence[str],
    by: str,
    tie: str,
    slice_by: Column,
    backwards: bool = True,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``row_number``, ``rank`` and ``dense_rank`` of ``by`` per key, over all rows."""
    sliced = _sliced(df, keys, slice_by, hot_rows)
    per_slice = sliced.where("_hot").groupBy(*keys, "_slice").agg(
        F.count("*").alias("_rows"),
        # NULL is a step of its own, which a distinct count leaves out
        (F.count_distinct(by) + F.max(F.col(by).isNull().cast("int"))).alias("_steps"),
    )
    before = _earlier(keys, backwards)
    seeds = per_slice.select(
        *keys,
        "_slice",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows"),
        F.coalesce(F.sum("_steps").over(before), F.lit(0)).alias("_steps"),
    )
    group = _groups(keys)
    by_value = group.orderBy("_seq", *_ordered([by], backwards))
    by_row = group.orderBy("_seq", *_ordered([by], backwards), F.col(tie).asc())
    head = by_row.rowsBetween(Window.unboundedPreceding, 0)
    # The seed row is itself the first of its slice, and must not count.
    seed = F.when(F.col("_hot"), 1).otherwise(0)
    rows_before = F.coalesce(F.first("_rows").over(head), F.lit(0)) - seed
    steps_before = F.coalesce(F.first("_steps").over(head), F.lit(0)) - seed
    return (
        _with_seeds(sliced, seeds)
        .withColumns(
            {
                "row_number": (F.row_number().over(by_row) + rows_before).cast("int"),
                "rank": (F.rank().over(by_value) + rows_before).cast("int"),
                "dense_rank": (F.dense_rank().over(by_value) + steps_before).cast("int"),
            }
        )
        .where("_seq = 1")
        .drop("_seq", "_hot", "_slice", "_rows", "_steps")
    )


def top_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows per key. Spark cuts each task to ``n`` rows per key before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rn", rank).where(F.col("_rn") <= n).drop("_rn")


def latest(df: DataFrame, keys: Sequence[str], at: str, tie: str) -> DataFrame:
    """Newest row per key; rows without a time lose, ``tie`` settles equal times."""
    return top_n(df, keys, [F.col(at).desc_nulls_last(), F.col(tie).desc()], 1)


def moving_average(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    slice_by: Column,
    value: str,
    n: int,
    name: str,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Average over the current and the ``n - 1`` rows before it.

    The position of a row is its running count; a frame of ``n`` rows is then a range of
    positions, which :func:`rolling_sums` spreads over slices of positions.
    """
    base = _flagged(df, keys, hot_rows)
    placed = running_sums(base, keys, order, slice_by, {"_pos": F.lit(1)})
    by_pos = F.floor(F.col("_pos") / max(1, hot_rows // 2))
    out = rolling_average(placed, keys, "_pos", by_pos, value, n - 1, name)
    return _without(out, df, "_pos", "_hot")
