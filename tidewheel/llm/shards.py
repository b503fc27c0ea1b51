"""Shards of near equal bytes by histogram sort.

Rows are ordered by a hash of the text (equal texts lie side by side, the order is a fixed shuffle)
and, within one text, by their place in the input. Splitters of that order are searched from outside:
each round counts the exact bytes between evenly spaced probes inside every open interval, in one
aggregation that combines in each task, and keeps for each splitter the gap that holds its target.
A splitter is done once a probe is within tolerance. An interval that shrinks to one hash value and
still misses (a text that fills more than a shard) is refined further by the rows' places, so a
group of copies of any size is split. Then the rows move once, by range.

The driver sees at most ``splitters x FAN`` counts a round, whatever the input.

Defined results: a NULL text has no bytes. Copies of a row are split like other rows. An empty table
gives no rows. Fewer rows than shards leave shards empty. Extra columns stay, but for the two names
added, ``shard`` and ``slot``, which replace columns of those names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.words import has_column
from tidewheel.sources.sinks import materialised

ROW_BYTES = 16
FAN = 256
TOP = 1 << 63


def row_size(text: str = "text"):
    return (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + ROW_BYTES).cast("long")


def _refine(keys: DataFrame, key: str, aims: dict[int, int], base: int, lo: int, hi: int, slack: int):
    """Key boundaries for ``aims`` (splitter -> bytes that should lie below it).

    Returns ``(done, tied)``: boundaries found, and for splitters inside the rows of one key value
    ``(value, bytes below it)``. A gap that holds one row is cut at its nearer side.
    """
    state = {j: (lo, hi, base) for j in aims}
    done: dict[int, int] = {}
    tied: dict[int, tuple[int, int]] = {}
    while state:
        gaps = sorted({(a, b) for a, b, _ in state.values()})
        steps = [max(1, -(-(b - a) // FAN)) for a, b in gaps]
        k = F.col(key)
        nth = sum((k >= F.lit(a)).cast("int") for a, _ in gaps)
        listed = lambda values: f"element_at(array({','.join(f'{v}L' for v in values)}), _g)"
        counted = (
            keys.select(k, "_size", nth.alias("_g"))
            .where("_g > 0")
            .where(F.expr(f"{key} < {listed([b for _, b in gaps])}"))
            .select("_g", F.expr(f"({key} - {listed([a for a, _ in gaps])}) div {listed(steps)}").alias("_c"), k, "_size")
            .groupBy("_g", "_c")
            .agg(F.sum("_size").alias("bytes"), F.count("*").alias("n"), F.min(k).alias("lo"), F.max(k).alias("hi"))
            .collect()
        )  # at most FAN rows for each open interval
        cells: dict[int, list] = {}
        for r in sorted(counted, key=lambda r: (r["_g"], r["_c"])):
            cells.setdefault(r["_g"] - 1, []).append(r)
        for j, (a, b, below) in list(state.items()):
            place = below
            for r in cells.get(gaps.index((a, b)), []):
                if place + r["bytes"] >= aims[j]:
                    break
                place += r["bytes"]
            else:
                done[j] = b  # nothing left of the gap reaches the target
                del state[j]
                continue
            before, after = aims[j] - place, place + r["bytes"] - aims[j]
            if min(before, after) <= slack or r["n"] == 1:
                done[j] = r["lo"] if before <= after else r["hi"] + 1
            elif r["lo"] == r["hi"]:
                tied[j] = (r["lo"], place)
            else:
                state[j] = (r["lo"], r["hi"] + 1, place)
                continue
            del state[j]
    return done, tied


def splitters(keys: DataFrame, n_shards: int, tolerance: float) -> list[tuple[int, int]]:
    """``n_shards - 1`` boundaries ``(hash, place)``; a row belongs right of a boundary it reaches."""
    total = keys.agg(F.coalesce(F.sum("_size"), F.lit(0)), F.coalesce(F.max("_place"), F.lit(0))).first()
    slack = int(total[0] / n_shards * tolerance)
    aims = {j: total[0] * j // n_shards for j in range(1, n_shards)}
    done, tied = _refine(keys, "_hash", aims, 0, 0, TOP - 1, slack)
    out = {j: (v, 0) for j, v in done.items()}
    for value, below in sorted(set(tied.values())):  # texts that fill a shard: fewer than n_shards
        own = {j: aims[j] for j, t in tied.items() if t == (value, below)}
        found, _ = _refine(keys.where(F.col("_hash") == value), "_place", own, below, 0, total[1] + 1, slack)  # places differ
        out |= {j: (value, p) for j, p in found.items()}
    return [out[j] for j in sorted(out)]


def shard_by_bytes(docs: DataFrame, n_shards: int = 40, tolerance: float = 0.001, text: str = "text") -> DataFrame:
    """``docs`` with ``shard`` (0 to ``n_shards - 1``) and ``slot`` (gapless from 0 in each shard)."""
    has_column(docs, text)
    own = [F.col(f"`{c}`") for c in docs.columns if c not in ("shard", "slot")]
    placed = docs.select(
        *own,
        F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col(text), F.lit(""))), 1).alias("_hash"),
        F.monotonically_increasing_id().alias("_place"),
    )
    keys = materialised(placed.select("_hash", "_place", row_size(text).alias("_size")), "shard-keys")
    shard = F.lit(0)
    for h, p in splitters(keys, n_shards, tolerance):
        reached = F.col("_hash") >= h if p == 0 else (F.col("_hash") > h) | ((F.col("_hash") == h) & (F.col("_place") >= p))
        shard = shard + reached.cast("int")
    moved = (
        placed.withColumn("shard", shard)
        .repartitionByRange("shard", "_hash", "_place")
        .sortWithinPartitions("shard", "_hash", "_place")
        .drop("_hash", "_place")
        .withColumn("_at", F.monotonically_increasing_id())
    )
    written = materialised(moved, "shards").withColumn("_part", F.shiftright("_at", 33))
    # one row for each shard and file; the rows before it in its shard are those of earlier files
    runs = written.groupBy("shard", "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = F.expr("coalesce(sum(_n) over (partition by shard order by _part rows between unbounded preceding and 1 preceding), 0)")
    runs = runs.select("shard", "_part", "_first", before.alias("_before"))
    # files follow the order of the shards, so these are no more than files and shards together
    return written.join(F.broadcast(runs), ["shard", "_part"]).select(
        *own, "shard", (F.col("_before") + F.col("_at") - F.col("_first")).alias("slot")
    )
