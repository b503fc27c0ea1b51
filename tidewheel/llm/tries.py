"""Trie of conversation prefixes by fixed-length block hashing.

Turns become digests once, so texts never move. Conversations are cut into blocks of ``BLOCK`` turns;
a block has one digest, and the digests of successive blocks are chained, so that conversations with
equal chains agree in whole blocks. Rows of one block and chain are counted as one *class*. Only where
a class has siblings (other blocks after the same chain) are turn boundaries refined: the digests of the
turns inside each of these blocks are chained and the classes that agree up to a turn are added up.
A class without siblings has its members at every turn of its block, without a look at its turns.

A node is then named by its smallest member and its depth. Sums over subtrees come by doubling: after
round ``k`` a node holds the sums of its descendants at distance below ``2^k``, and the next round adds
those of the descendants at distance ``2^k``, found on the path of the node's smallest member; so the
number of rounds is the logarithm of the longest conversation, whatever the shape of the trie.

Nothing collects a group of unknown size: arrays hold at most ``BLOCK * SPAN`` turns, chains of longer
conversations go over spans of blocks, spans of spans and so on; a conversation with very many turns
is numbered slice by slice; the list of conversations that end at a node is written in pieces and
hashed as a stream.

Digests are the first 128 bits of SHA-256.

Defined cases: rows without ``conv_id`` belong to no conversation. Turns are ordered by ``turn`` (NULL
first), equal ones by the digest of role and text; repeated rows are turns of their own. NULL role or
text is the empty string. Extra columns are ignored. A table without conversations has no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.words import has_column
from tidewheel.operators.windows import running_sums
from tidewheel.sources.sinks import materialised

BLOCK = 8  # turns of a block
SPAN = 64  # blocks (or spans) whose digests are chained in one row
PIECE = 4096  # conversation numbers of one piece of a list
SLICE = 100_000  # turn numbers of one slice of a very long conversation
_NONE = bytes(16)


def _digest(value: Column) -> Column:
    return F.substring(F.unhex(F.sha2(value, 256)), 1, 16)


def _joined(digests: Column, first: Column) -> Column:
    return F.aggregate(digests, first, lambda a, x: F.concat(a, x))


def numbered_turns(turns: DataFrame) -> DataFrame:
    """``_c`` (conversation), ``_p`` (place from 0), ``_h`` (digest), ``_z`` (bytes of the text)."""
    has_column(turns, "conv_id", "turn", "role", "text")
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")
    rows = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("_c"), F.col("turn").alias("_t"), _digest(whole).alias("_h"),
        F.octet_length(text).cast("long").alias("_z"),
    )
    rows = materialised(rows, "turns")
    placed = running_sums(rows, ["_c"], ["_t", "_h"], F.floor(F.col("_t") / SLICE), {"_p": F.lit(1)})
    return materialised(placed.select("_c", (F.col("_p") - 1).cast("int").alias("_p"), "_h", "_z"), "numbered-turns")


def with_shared_openings(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations ``c`` that open with the first ``h`` turns of ``c - c % 5``, ``h`` the CRC-32 of the
    decimal ``c`` modulo 9, and go on with their own turns after the first ``h``.

    Returns the rows of the rebuilt conversations and all conversations (``_c``).
    """
    convs = rows.groupBy("_c").agg(F.count("*").alias("_own"))
    most = F.crc32(F.col("_c").cast("string").cast("binary")) % 9
    convs = convs.select("_c", (F.col("_c") - F.col("_c") % 5).alias("_base"), most.cast("int").alias("_most"))
    heads = rows.where("_c % 5 = 0 AND _p < 8").groupBy(F.col("_c").alias("_base")).agg(
        F.sort_array(F.collect_list(F.struct("_p", "_h", "_z"))).alias("_head")
    )
    opened = convs.join(heads, "_base", "left").withColumn(
        "_head", F.slice(F.coalesce("_head", F.array()), F.lit(1), F.col("_most"))
    )
    opened = materialised(opened.select("_c", "_most", "_head"), "openings")
    first = opened.select("_c", F.explode("_head").alias("_x")).select("_c", "_x._p", "_x._h", "_x._z")
    own = rows.join(opened.select("_c", "_most", F.size("_head").alias("_n")), "_c").where("_p >= _most")
    own = own.select("_c", (F.col("_p") - F.col("_most") + F.col("_n")).alias("_p"), "_h", "_z")
    return first.unionByName(own), opened.select("_c")


def _chained(items: Column, first: Column) -> Column:
    """Chain over structs with ``d``: the same structs with the chain ``before`` and ``after`` each."""
    start = F.struct(first.alias("at"), F.array().cast("array<struct<before:binary,after:binary>>").alias("all"))

    def step(a: Column, x: Column) -> Column:
        after = _digest(F.concat(a["at"], x["d"]))
        return F.struct(after.alias("at"), F.concat(a["all"], F.array(F.struct(a["at"].alias("before"), after.alias("after")))).alias("all"))

    return F.aggregate(items, start, step, lambda a: a["all"])


def _starts(spans: DataFrame) -> DataFrame:
    """Spans (``_c``, ``_s``, ``_d``) of a conversation with the chain up to each span as ``_start``."""
    last = spans.agg(F.coalesce(F.max("_s"), F.lit(0))).first()[0]
    if not last:
        return spans.select("_c", "_s", F.lit(_NONE).alias("_start"))
    upper = spans.groupBy("_c", F.floor(F.col("_s") / SPAN).cast("int").alias("_u")).agg(
        F.sort_array(F.collect_list(F.struct(F.col("_s").alias("s"), F.col("_d").alias("d")))).alias("_x")
    )
    upper = materialised(upper, "spans")
    above = _starts(upper.select("_c", F.col("_u").alias("_s"), _digest(_joined(F.col("_x.d"), F.lit(b""))).alias("_d")))
    both = upper.join(above.withColumnRenamed("_s", "_u"), ["_c", "_u"])
    pairs = both.select("_c", F.explode(F.arrays_zip(F.col("_x.s").alias("s"), _chained(F.col("_x"), F.col("_start")).alias("k"))).alias("_y"))
    return pairs.select("_c", F.col("_y.s").alias("_s"), F.col("_y.k.before").alias("_start"))


def _blocks(rows: DataFrame) -> DataFrame:
    """Blocks of all conversations: ``_c``, ``_b``, ``_before`` and ``_chain`` (16 bytes), turn digests
    ``_ts`` and text sizes ``_zs``."""
    held = rows.groupBy("_c", F.floor(F.col("_p") / (BLOCK * SPAN)).cast("int").alias("_s")).agg(
        F.sort_array(F.collect_list(F.struct("_p", "_h", "_z"))).alias("_x")
    )
    cut = F.transform(
        F.sequence(F.lit(0), F.floor((F.size("_x") - 1) / BLOCK).cast("int")),
        lambda k: F.slice("_x", k * BLOCK + 1, F.lit(BLOCK)),
    )
    digested = F.transform(
        cut,
        lambda x: F.struct(
            F.transform(x, lambda t: t["_h"]).alias("ts"), F.transform(x, lambda t: t["_z"]).alias("zs"),
            _digest(_joined(F.transform(x, lambda t: t["_h"]), F.lit(b""))).alias("d"),
        ),
    )
    spans = materialised(held.select("_c", "_s", digested.alias("_x")), "turn-blocks")
    starts = _starts(spans.select("_c", "_s", _digest(_joined(F.col("_x.d"), F.lit(b""))).alias("_d")))
    zipped = F.arrays_zip(F.col("_x").alias("x"), _chained(F.col("_x"), F.col("_start")).alias("k"))
    return spans.join(starts, ["_c", "_s"]).select("_c", "_s", F.posexplode(zipped).alias("_j", "_y")).select(
        "_c", (F.col("_s") * SPAN + F.col("_j")).alias("_b"), F.col("_y.k.before").alias("_before"),
        F.col("_y.k.after").alias("_chain"), F.col("_y.x.ts").alias("_ts"), F.col("_y.x.zs").alias("_zs"),
    )


def _ended(ends: DataFrame) -> DataFrame:
    """Digest of the sorted, comma-joined conversation numbers of each (``_c``, ``_d``)."""
    pieces = ends.groupBy("_c", "_d", F.floor(F.col("_who") / PIECE).alias("_q")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("_who")), lambda c: c.cast("string")), ",").alias("_text")
    )

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha, out = None, None, []
        for batch in batches:
            for c, d, text in zip(*(batch.column(n).to_pylist() for n in ("_c", "_d", "_text")), strict=True):
                if (c, d) == node:
                    sha.update(b",")
                else:
                    if node is not None:
                        out.append((*node, sha.hexdigest()))
                    node, sha = (c, d), hashlib.sha256()
                sha.update(text.encode())
            if out:
                yield _batch(out)
                out = []
        if node is not None:
            yield _batch([(*node, sha.hexdigest())])

    dealt = pieces.repartition("_c", "_d").sortWithinPartitions("_c", "_d", "_q").select("_c", "_d", "_text")
    return dealt.mapInArrow(stream, "_c long, _d int, _sha string")


def _batch(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    c, d, sha = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()), pa.array(d, pa.int32()), pa.array(sha, pa.string())], ["_c", "_d", "_sha"])


def _classes(blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes below the root (``_c``, ``_d``, ``_n`` members, ``_z`` bytes of the last text), and per chain
    the smallest member at each turn of its block (``_ms``)."""
    whole = blocks.groupBy("_b", "_before", "_chain", "_ts", "_zs").agg(F.count("*").alias("_n"), F.min("_c").alias("_m"))
    whole = materialised(whole, "block-classes")
    alone = whole.groupBy("_b", "_before").agg(F.count("*").alias("_k"), F.min("_chain").alias("_chain")).where("_k = 1")
    flagged = whole.join(alone.select("_chain", F.lit(True).alias("_alone")), "_chain", "left")
    flagged = materialised(flagged.withColumn("_alone", F.coalesce("_alone", F.lit(False))), "flagged-classes")

    lone, rest = flagged.where("_alone"), flagged.where("NOT _alone")
    depth = (F.col("_b") * BLOCK + F.col("_j") + 1).cast("int").alias("_d")
    lone_nodes = lone.select("_m", "_n", "_b", F.posexplode("_zs").alias("_j", "_z"))
    lone_nodes = lone_nodes.select(F.col("_m").alias("_c"), depth, "_n", "_z")
    upto = F.transform(
        F.sequence(F.lit(1), F.size("_ts")), lambda j: _digest(_joined(F.slice("_ts", F.lit(1), j), F.col("_before")))
    )
    turns = rest.select(
        "_chain", "_b", "_n", "_m", F.posexplode(F.arrays_zip(upto.alias("key"), F.col("_zs").alias("z"))).alias("_j", "_x")
    ).select("_chain", "_j", depth, "_n", "_m", F.col("_x.key").alias("_key"), F.col("_x.z").alias("_z"))
    turns = materialised(turns, "refined-turns")
    refined = materialised(turns.groupBy("_key", "_d", "_z").agg(F.sum("_n").alias("_n"), F.min("_m").alias("_c")), "refined-nodes")
    nodes = lone_nodes.unionByName(refined.select("_c", "_d", "_n", "_z"))
    labels = turns.join(refined.select("_key", "_c"), "_key").groupBy("_chain").agg(
        F.sort_array(F.collect_list(F.struct("_j", "_c"))).alias("_x")
    )
    members = lone.select("_chain", F.array_repeat(F.col("_m"), F.size("_ts")).alias("_ms")).unionByName(
        labels.select("_chain", F.col("_x._c").alias("_ms"))
    )
    return nodes, members


NODE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string"
)


def prefix_trie(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """Nodes of the trie, the root included, as ``NODE``.

    ``rows`` hold ``_c``, ``_p`` (0, 1, ... in each conversation), ``_h``, ``_z`` as of
    :func:`numbered_turns`; ``convs`` hold every conversation once (``_c``), with or without turns.
    """
    spark = rows.sparkSession
    n_convs, root = convs.agg(F.count("*"), F.min("_c")).first()
    if not n_convs:
        return spark.createDataFrame([], NODE)
    blocks = materialised(_blocks(rows), "blocks-chained")
    nodes, members = _classes(blocks)
    paths = materialised(blocks.select("_c", "_b", "_chain").join(members, "_chain").select("_c", "_b", "_ms"), "paths")

    last = paths.groupBy("_c").agg(
        F.max_by(F.element_at("_ms", -1), "_b").alias("_m"), F.max(F.col("_b") * BLOCK + F.size("_ms")).cast("int").alias("_d")
    )
    ends = materialised(
        convs.join(last, "_c", "left").select(
            F.col("_c").alias("_who"), F.coalesce("_m", F.lit(root)).alias("_c"), F.coalesce("_d", F.lit(0)).alias("_d")
        ),
        "ends",
    )
    # places on the paths of conversations that give their name to a node; the root is known
    named = ends.where("_who = _c").select("_c")
    steps = paths.join(named, "_c", "left_semi").select("_c", "_b", F.posexplode("_ms").alias("_j", "_m"))
    steps = materialised(steps.select("_c", (F.col("_b") * BLOCK + F.col("_j") + 1).cast("int").alias("_d"), "_m"), "steps")

    def above(df: DataFrame, distance: int) -> DataFrame:
        """The node ``distance`` above each row's, as ``_up``, for rows that have one."""
        deep = df.where(F.col("_d") > distance).withColumn("_at", F.col("_d") - distance)
        found = deep.join(steps.select("_c", F.col("_d").alias("_at"), F.col("_m").alias("_up")), ["_c", "_at"])
        return found.drop("_at").unionByName(df.where(F.col("_d") == distance).withColumn("_up", F.lit(root).cast("long")))

    top = spark.range(1).select(F.lit(root).cast("long").alias("_c"), F.lit(0).alias("_d"), F.lit(n_convs).cast("long").alias("_n"),
                                F.lit(0).cast("long").alias("_z"))
    parents = above(nodes, 1).unionByName(top.withColumn("_up", F.lit(None).cast("long")))
    parents = materialised(parents, "nodes")
    children = parents.where("_up IS NOT NULL").groupBy(F.col("_up").alias("_c"), (F.col("_d") - 1).alias("_d")).agg(
        F.count("*").alias("_children")
    )
    full = parents.join(children, ["_c", "_d"], "left").withColumn("_children", F.coalesce("_children", F.lit(0).cast("long")))
    full = materialised(full, "nodes-with-children")
    deepest = full.agg(F.max("_d")).first()[0]

    sums = full.select("_c", "_d", (F.col("_children") == 0).cast("long").alias("_leaves"), ((F.col("_n") - 1) * F.col("_z")).alias("_saved"))
    distance = 1
    while distance <= deepest:
        given = above(sums, distance).select(F.col("_up").alias("_c"), (F.col("_d") - distance).alias("_d"), "_leaves", "_saved")
        total = sums.unionByName(given).groupBy("_c", "_d").agg(F.sum("_leaves").alias("_leaves"), F.sum("_saved").alias("_saved"))
        sums = materialised(total, "subtree-sums")
        distance *= 2

    out = full.join(sums, ["_c", "_d"]).join(_ended(ends), ["_c", "_d"], "left")
    return out.select(
        F.col("_c").alias("conv_id"), F.col("_d").cast("long").alias("depth"), F.col("_up").alias("parent_conv_id"),
        F.col("_n").alias("n_convs"), F.col("_children").alias("n_children"), F.col("_leaves").alias("n_leaves"),
        F.col("_saved").alias("saved_tokens"), F.coalesce("_sha", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )
