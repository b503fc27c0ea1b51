"""Groups of similar texts by MinHash signatures, without comparing all pairs.

1. Texts equal but for case, punctuation and spacing count once (their smallest id stands for them).
2. A text is the set of its five-word shingles, as 64-bit digests. ``BANDS * ROWS`` MinHash values of a
   set are minima of as many hashes, formed in each task before anything is shuffled.
3. Texts that agree in a band meet in its bucket. A bucket names a representative and every member is
   compared with it alone; members unlike it name another one in the next of ``rounds`` passes. So a
   bucket with a third of all texts costs one comparison per member and pass, not one per pair.
4. A candidate pair is kept if the two sets themselves have the asked Jaccard similarity.
5. Groups are the connected components of the kept pairs.

Texts of similarity 0.75 share a band with probability 1 - (1 - 0.75^4)^16 = 0.998, and texts of one
group usually do so along several ways. What is reported as a pair always has the similarity; a pair
may be missed only if its texts share no bucket in which one of them comes to represent.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.functions.text import squeezed, text_key
from tidewheel.operators.graphs import components
from tidewheel.sources.sinks import materialised

WORDS = 5
BANDS, ROWS = 16, 4


def shingles(text: Column, words: int = WORDS) -> Column:
    """Sorted distinct digests of all stretches of ``words`` words; a shorter text is one stretch."""
    split = F.filter(F.split(squeezed(text), " "), lambda w: w != "")
    many = lambda w: F.transform(
        F.sequence(F.lit(1), F.size(w) - (words - 1)), lambda i: F.xxhash64(F.array_join(F.slice(w, i, F.lit(words)), " "))
    )
    few = lambda w: F.when(F.size(w) > 0, F.array(F.xxhash64(F.array_join(w, " ")))).otherwise(F.array().cast("array<bigint>"))
    # an array of one lets the words be split once
    sets = F.transform(F.array(split), lambda w: F.when(F.size(w) >= words, many(w)).otherwise(few(w)))[0]
    return F.array_sort(F.array_distinct(F.coalesce(sets, F.array().cast("array<bigint>"))))


def signatures(sets: DataFrame, row_id: str, members: str, n: int = BANDS * ROWS) -> DataFrame:
    """``row_id`` and ``sig``, the ``n`` MinHash values of each set that has members."""
    rows = sets.select(row_id, F.explode(members).alias("_m"))
    minima = rows.groupBy(row_id).agg(*[F.min(F.xxhash64("_m", F.lit(k))).alias(f"_{k}") for k in range(n)])
    return minima.select(row_id, F.array(*[F.col(f"_{k}") for k in range(n)]).alias("sig"))


def band_buckets(signed: DataFrame, row_id: str, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per text and band: ``bucket``, a digest of the band's number and values."""
    keys = [F.xxhash64(F.lit(b), *[F.col("sig")[b * rows + r] for r in range(rows)]) for b in range(bands)]
    return signed.select(row_id, F.explode(F.array(*keys)).alias("bucket"))


def alike(shared: Column, left: Column, right: Column, percent: int) -> Column:
    """Is the Jaccard similarity at least ``percent`` in a hundred? In whole numbers, without rounding."""
    return 100 * shared >= percent * (left + right - shared)


def similar_pairs(sets: DataFrame, percent: int = 75, rounds: int = 3) -> DataFrame:
    """Pairs (``a``, ``b``) of ids whose sets (``_id``, ``_set``) are similar, each compared in full."""
    sized = sets.select("_id", F.size("_set").cast("long").alias("_n"), "_set")
    waiting = materialised(band_buckets(signatures(sets, "_id", "_set"), "_id"), "buckets")
    kept = []
    for _ in range(rounds):
        heads = waiting.groupBy("bucket").agg(F.min("_id").alias("_head"), F.count("*").alias("_k")).where("_k > 1")
        faced = materialised(waiting.join(heads.select("bucket", "_head"), "bucket").where("_id <> _head"), "faced")
        pairs = faced.select("_id", "_head").distinct()
        near = pairs.join(sized.select("_id", "_n"), "_id").join(
            sized.select(F.col("_id").alias("_head"), F.col("_n").alias("_hn")), "_head"
        )
        near = near.where(alike(F.least("_n", "_hn"), F.col("_n"), F.col("_hn"), percent))
        both = near.join(sized.select("_id", "_set"), "_id").join(
            sized.select(F.col("_id").alias("_head"), F.col("_set").alias("_hset")), "_head"
        )
        shared = F.size(F.array_intersect("_set", "_hset")).cast("long")
        found = both.where(alike(shared, F.col("_n"), F.col("_hn"), percent)).select("_id", "_head")
        found = materialised(found, "similar-pairs")
        kept.append(found)
        waiting = materialised(faced.join(found, ["_id", "_head"], "left_anti").select("_id", "bucket"), "buckets")
    every = reduce(DataFrame.unionByName, kept)
    return every.select(F.col("_head").alias("a"), F.col("_id").alias("b")).distinct()


def similar_groups(df: DataFrame, text: str, row_id: str, percent: int = 75, rounds: int = 3) -> DataFrame:
    """``row_id`` and ``group_id``, the smallest id of its group. Ids must be unique and not NULL.

    A NULL text and a text without letters or digits are alike to nothing.
    """
    plain = df.select(F.col(row_id).alias("_id"), F.col(text).alias("_text"))
    keyed = plain.select("_id", F.when(F.length(squeezed("_text")) > 0, text_key("_text")).alias("_key"))
    keyed = materialised(keyed, "text-keys")
    firsts = materialised(keyed.where("_key IS NOT NULL").groupBy("_key").agg(F.min("_id").alias("_first")), "first-texts")
    once = plain.join(firsts.select(F.col("_first").alias("_id")), "_id", "left_semi")
    sets = materialised(once.select("_id", shingles(F.col("_text")).alias("_set")), "shingle-sets")
    found = components(similar_pairs(sets, percent, rounds))
    named = firsts.join(found.withColumnRenamed("node", "_first"), "_first", "left")
    named = named.select("_key", F.coalesce("component", "_first").alias("_group"))
    return keyed.join(named, "_key", "left").select(
        F.col("_id").alias(row_id), F.coalesce("_group", "_id").alias("group_id")
    )


def drop_similar(df: DataFrame, text: str, row_id: str, percent: int = 75, rounds: int = 3) -> DataFrame:
    """The row with the smallest id of each group, with all columns."""
    groups = similar_groups(df, text, row_id, percent, rounds)
    return df.join(groups.where(F.col("group_id") == F.col(row_id)).select(row_id), row_id, "left_semi")
