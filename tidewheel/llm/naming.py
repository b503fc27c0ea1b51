"""Exact deduplication by deterministic block naming.

A text (A-Z lower-cased) is cut into blocks of ``block`` bytes. All distinct blocks are sorted and
numbered; then every two adjacent numbers of a document form a pair, the distinct pairs are sorted
and numbered in turn, and so on until one number stands for the whole document. Two documents of
equally many blocks get the same number exactly if their texts are equal: no step rests on a digest.

Blocks are sorted by a 64-bit digest first and by their bytes where a digest is shared by different
blocks, so that bytes cross the network once (one smallest and one largest block per digest and
task) to find those digests, and afterwards only where they decide. Every round halves the numbers
of a document; documents with one number left take no further part. Hot blocks and pairs are
combined before each shuffle, and joins back to their occurrences are equi-joins that adaptive
execution splits.

Defined cases: NULL and empty texts are equal (no blocks). Rows are never merged: repeated rows,
repeated ids and NULL ids give one output row each; of equal texts the row with the largest id stays
(NULL is the smallest), of several such rows one. Extra columns are ignored by :func:`named` and
returned as they are by :func:`deduplicated`. An empty table gives an empty result.

The input is read twice and must give the same texts both times.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.words import ascii_lower, has_column
from tidewheel.sources.sinks import materialised

BLOCK = 2048
#: So many shared digests are looked up as a list; beyond it every block is sorted by its bytes.
LISTED = 1000


def _normal(text: str) -> Column:
    return ascii_lower(F.coalesce(F.col(text), F.lit(""))).cast("binary")


def _cut(data: Column, block: int) -> Column:
    """Blocks of a binary value in order; none for an empty one. ``data`` is evaluated once."""
    starts = lambda b: F.sequence(F.lit(1), F.greatest(F.octet_length(b), F.lit(1)), F.lit(block))
    pieces = F.transform(F.array(data), lambda b: F.transform(starts(b), lambda i: F.substring(b, i, F.lit(block))))[0]
    return F.filter(pieces, lambda p: F.octet_length(p) > 0)


def _shared_digests(docs: DataFrame, text: str, block: int, digest: Callable[[Column], Column]) -> Callable[[Column], Column]:
    """Condition that is true for the digests of more than one block."""
    pieces = docs.select(F.explode(_cut(_normal(text), block)).alias("_b"))
    ends = pieces.groupBy(digest(F.col("_b")).alias("_d")).agg(F.min("_b").alias("_lo"), F.max("_b").alias("_hi"))
    found = [r[0] for r in ends.where("_lo <> _hi").select("_d").limit(LISTED + 1).collect()]
    if len(found) > LISTED:
        return lambda d: F.lit(True)
    return lambda d: d.isin(found) if found else F.lit(False)


def _numbered(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with the rank of their key among all distinct keys, sorted, as ``_name``."""
    ranked = rows.select(*keys).distinct().sort(*keys).withColumn("_name", F.monotonically_increasing_id())
    names = materialised(ranked, "block-names")  # numbers hold for the table as written
    return materialised(rows.join(names, keys).select("_n", "_i", "_m", "_name"), "named-blocks")


def _identified(
    docs: DataFrame, text: str, row_id: str, block: int, digest: Callable[[Column], Column], carry: bool
) -> DataFrame:
    """One row per document: ``_n``, ``_id``, ``_sha``, (``_blocks``, ``_name``) and, if asked, ``_row``."""
    shared = _shared_digests(docs, text, block, digest)

    def key(piece: Column) -> Column:
        bytes_too = F.when(shared(digest(piece)), piece).otherwise(F.lit(b""))
        return F.struct(digest(piece).alias("_d"), bytes_too.alias("_b"))

    whole = docs.select(
        F.monotonically_increasing_id().alias("_n"),
        F.col(row_id).alias("_id"),
        # one evaluation of the text serves the hash and the blocks
        F.transform(
            F.array(_normal(text)),
            lambda b: F.struct(F.sha2(b, 256).alias("_sha"), F.transform(_cut(b, block), key).alias("_keys")),
        )[0].alias("_t"),
        *([F.struct("*").alias("_row")] if carry else []),
    )
    whole = materialised(
        whole.select("_n", "_id", "_t._sha", "_t._keys", F.size("_t._keys").alias("_blocks"), *(["_row"] if carry else [])),
        "blocks",
    )
    most = whole.agg(F.coalesce(F.max("_blocks"), F.lit(0))).first()[0]
    if not most:
        return whole.drop("_keys").withColumn("_name", F.lit(0).cast("long"))

    at = whole.select("_n", F.col("_blocks").alias("_m"), F.posexplode("_keys").alias("_i", "_k"))
    rows = _numbered(at.select("_n", "_i", "_m", "_k._d", "_k._b"), ["_d", "_b"])
    ends = [rows.where("_m = 1")]
    for _ in range((most - 1).bit_length()):
        side = lambda odd: F.max(F.when(F.col("_i") % 2 == odd, F.col("_name")))
        pairs = (
            rows.where("_m > 1")
            .groupBy("_n", F.floor(F.col("_i") / 2).cast("int").alias("_j"))
            .agg(F.max("_m").alias("_m"), side(0).alias("_left"), F.coalesce(side(1), F.lit(-1)).alias("_right"))
        )
        pairs = pairs.select("_n", F.col("_j").alias("_i"), F.ceil(F.col("_m") / 2).cast("int").alias("_m"), "_left", "_right")
        rows = _numbered(materialised(pairs, "block-pairs"), ["_left", "_right"])
        ends.append(rows.where("_m = 1"))
    final = ends[0]
    for more in ends[1:]:
        final = final.unionByName(more)
    bare = whole.drop("_keys")
    found = bare.where("_blocks > 0").join(final.select("_n", "_name"), "_n")
    return found.unionByName(bare.where("_blocks = 0").withColumn("_name", F.lit(0).cast("long")))


def _judged(
    docs: DataFrame, text: str, row_id: str, block: int, digest: Callable[[Column], Column], carry: bool
) -> DataFrame:
    has_column(docs, text, row_id)
    rows = materialised(_identified(docs, text, row_id, block, digest, carry), "identities")
    same = ["_blocks", "_name"]
    groups = rows.groupBy(*same).agg(F.count("*").alias("_size"), F.max(F.struct("_id", (-F.col("_n")).alias("_n"))).alias("_keep"))
    groups = groups.select(*same, "_size", F.col("_keep._id").alias("_keep_id"), (-F.col("_keep._n")).alias("_keep_n"))
    return rows.join(groups, same).withColumn("_kept", F.col("_n") == F.col("_keep_n"))


def named(
    docs: DataFrame, text: str = "text", row_id: str = "doc_id", block: int = BLOCK,
    digest: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """One row per document: id, ``keep_id`` (id of the row that stays), ``group_size``, ``kept``,
    ``text_sha256`` of the lower-cased text, and its identity (``n_blocks``, ``name``)."""
    return _judged(docs, text, row_id, block, digest, False).select(
        F.col("_id").alias(row_id), F.col("_keep_id").alias("keep_id"), F.col("_size").alias("group_size"),
        F.col("_kept").alias("kept"), F.col("_sha").alias("text_sha256"),
        F.col("_blocks").alias("n_blocks"), F.col("_name").alias("name"),
    )


def deduplicated(
    docs: DataFrame, text: str = "text", row_id: str = "doc_id", block: int = BLOCK,
    digest: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """The rows that stay, with the columns of ``docs``."""
    return _judged(docs, text, row_id, block, digest, True).where("_kept").select("_row.*")
