"""Exact Jaccard join of word-shingle sets: Voronoi regions around pivots, joined recursively.

Jaccard distance is a metric. If ``p`` is a pivot, ``x`` and ``y`` can be within ``r`` of each other
only if their distances to ``p`` differ by at most ``r``; and if both are within ``r`` of ``p``, both
link to it and need no comparison for their class to be known.

1. *Sets.* Each text becomes a set of hashed shingles; equal sets are one set from here on.
2. *Support.* Set members are dealt by hash, compressed, and counted. A set links only if three
   quarters of its members occur in other sets of like size; others are done. Nothing else about
   members moves.
3. *Regions.* Of two linked sets, the ``n / 4 + 1`` rarest members of each share one. Each such
   member spans a region of the sets of like size that have it among theirs; members with the same holders span one
   region together. In a region the set whose members are most widely shared is the pivot, and distances to it are
   exact. Its cell, the sets within ``r``, joins one class. The sets outside are faced in turn, more of them each
   round, by each other and by the *border* of the cell: sets whose distance to the pivot differs by at most ``r``.
   Sets known to be of one class are not compared again, and a region without sets outside is
   done. Small regions are joined directly. Before members of two sets meet, the pair must pass a bound on their
   difference: sizes, members that nobody else has, and parities of member counts by hash (each differing parity is a
   member of one set only). Similar texts that do not link are told apart by it without comparison.
4. *Classes.* After each round, connected components of the classes that it linked, by label
   propagation with pointer jumping.

Members are 48-bit hashes: two texts' sets are compared by their hashes, within one pair a collision
has a chance below 1e-7. Every stage is a Spark shuffle or join; number of parts follows the number
of members, the driver sees counts only.

Defined results: NULL and empty texts have the empty set and link with nothing. A text below five
words has one member, the whole of it. A class is named by the least ``doc_id`` in it; rows with
NULL ids take part and get the least known id of their class. Repeated rows share a class. Extra
columns stay in ``deduplicated`` and are not read in ``classes``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.llm.shingles import BITS as MEMBER_BITS
from tidewheel.llm.shingles import mix, shingle_sets
from tidewheel.llm.words import brought_back, has_column, set_aside
from tidewheel.llm.workers import handing_back
from tidewheel.sources.sinks import Scratch, broadcast_hint, materialised

PART = 4_000_000  # members in one part of a shuffle
HELD = 4_000_000  # members that a task deals at a time
RANGE = 500_000  # members that are matched at a time
OWNER_BITS = 15  # of a member's place in a task's memory; the others are its part and quotient
OWNERS = 1 << OWNER_BITS  # sets that a task deals at a time
TASKS = 50_000  # a task of a very large shuffle works on several parts, one after the other
LEAF = 64
BITS = 256
PIVOTS, MOST_PIVOTS = 16, 1024  # sets of a region that the others face, in the first round and later
STEP = 8  # sizes of one region's sets differ by this factor at most
BLOB = "part int, body binary"
_BLOB = pa.schema([("part", pa.int32()), ("body", pa.binary())])


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays of 64-bit numbers, byte planes together so that unused bytes cost nothing."""
    head = np.array([len(arrays), *map(len, arrays)], "<u4").view(np.uint8)
    raw, at = np.empty(len(head) + 8 * sum(map(len, arrays)), np.uint8), len(head)
    raw[:at] = head
    for a in arrays:
        raw[at : at + 8 * len(a)].reshape(8, -1)[:] = np.ascontiguousarray(a, "<u8").view(np.uint8).reshape(-1, 8).T
        at += 8 * len(a)
    return zstandard.ZstdCompressor(level=1).compress(raw)


def _unpacked(body: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(body)
    k = int(np.frombuffer(raw, "<u4", 1)[0])
    sizes = np.frombuffer(raw, "<u4", k, 4)
    at, out = 4 * (k + 1), []
    for n in map(int, sizes):
        planes = np.frombuffer(raw, np.uint8, 8 * n, at).reshape(8, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view("<u8").astype(np.uint64))
        at += 8 * n
    return out


def _rows(parts: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([p for p, _ in parts], pa.int32()), pa.array([b for _, b in parts], pa.binary())], schema=_BLOB
    )


def _runs(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of runs of equal values."""
    starts = np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]])) if len(sorted_values) else np.zeros(0, np.int64)
    return starts, np.diff(np.append(starts, len(sorted_values)))


def set_names(docs: DataFrame, key: str) -> DataFrame:
    """``key, n, set`` for each row: size and fingerprint of its set."""

    def names(batches):
        for batch in batches:
            for at, _, sizes, found in shingle_sets(batch.column(1)):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(sizes)), pa.array(sizes, pa.int64()), pa.array(found.astype(np.int64))],
                    names=[key, "n", "set"],
                )

    return docs.select(F.col(key).cast("long"), F.col("text").cast("string")).mapInArrow(handing_back(names), f"{key} long, n long, set long")


def _members(docs: DataFrame, parts: int) -> DataFrame:
    """Members of each task's different sets, dealt by hash into ``parts`` blobs at a time."""

    above = -(-(1 << MEMBER_BITS) // parts)  # members of one part have quotients below this

    def deal(held: list[np.ndarray], sizes: list[np.ndarray], names: list[np.ndarray]) -> pa.RecordBatch:
        n, name = np.concatenate(sizes), np.concatenate(names)
        keys, at = np.empty(sum(map(len, held)), np.uint64), 0
        while held:
            piece = held.pop()
            keys[at : at + len(piece)] = piece
            at += len(piece)
        keys.sort()  # by part, quotient and number of the set, in place
        ends = np.arange(1, parts, dtype=np.uint64) * np.uint64(above) << np.uint64(OWNER_BITS)
        out = []
        for part, dealt in enumerate(np.split(keys, np.searchsorted(keys, ends))):
            if len(dealt):
                owner = (dealt & np.uint64(OWNERS - 1)).astype(np.uint16)
                there = np.zeros(len(name), bool)
                there[owner] = True
                index = (np.cumsum(there) - 1).astype(np.uint16)[owner]  # of the owner among those of this part
                quotient = (dealt >> np.uint64(OWNER_BITS)) - np.uint64(part * above)  # what the part's number does not tell
                steps = np.diff(quotient, prepend=np.uint64(0))
                out.append((part, _packed(name[there], n[there], index, steps, np.array([part], np.uint64))))
        return _rows(out)

    def run(batches):
        seen: set[int] = set()
        held, size, sets = ([], [], []), 0, 0
        for batch in batches:
            for _, members, sizes, names in shingle_sets(batch.column(0)):
                fresh = np.zeros(len(sizes), bool)
                for i in np.flatnonzero(sizes):
                    name = int(names[i])
                    if name not in seen:
                        if len(seen) > 1_000_000:
                            seen.clear()  # a set sent twice is counted once by the receiver
                        seen.add(name)
                        fresh[i] = True
                if size and sets + int(fresh.sum()) > OWNERS:
                    yield deal(*held)
                    held, size, sets = ([], [], []), 0, 0
                h, n = members[np.repeat(fresh, sizes)], sizes[fresh]
                quotient = h // np.uint64(parts)
                keys = (h - quotient * np.uint64(parts)) * np.uint64(above) + quotient
                keys <<= np.uint64(OWNER_BITS)
                keys |= np.repeat(np.arange(sets, sets + len(n), dtype=np.uint64), n)
                held[0].append(keys)
                held[1].append(n)
                held[2].append(names[fresh])
                size, sets = size + len(keys), sets + len(n)
                if size >= HELD:
                    yield deal(*held)
                    held, size, sets = ([], [], []), 0, 0
        if size:
            yield deal(*held)

    return docs.select(F.col("text").cast("string")).mapInArrow(handing_back(run), BLOB)


def _by_part(blobs: DataFrame, parts: int, work):
    """The blobs dealt by part, and a task that runs ``work(bodies)`` on one part after the other."""

    def run(batches):
        part, bodies = None, []
        for batch in batches:
            for p, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if p != part and bodies:
                    yield from work(bodies)
                    bodies = []
                part = p
                bodies.append(body)
        if bodies:
            yield from work(bodies)

    return blobs.repartition(min(parts, TASKS), "part").sortWithinPartitions("part"), run


def _support(blobs: DataFrame, parts: int, percent: int) -> DataFrame:
    """Members that a set shares with one it may link to by size, with how many sets have them, dealt by set."""

    def shared(h: np.ndarray, own: np.ndarray, names: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of members of one range of hashes and the numbers of their sets: ``h, own, times, group`` of those that count."""
        order = np.argsort(h)
        same = h[order]
        same = same[1:] == same[:-1]
        twice = np.zeros(len(h), bool)
        twice[order[np.append(same, False)]] = True
        twice[order[np.append(False, same)]] = True
        del order, same
        h, own = h[twice], own[twice]
        order = np.lexsort((names[own], h))  # of shared members only
        h, own = h[order], own[order]
        if len(h):
            name = names[own]
            one = np.concatenate([[True], (h[1:] != h[:-1]) | (name[1:] != name[:-1])])
            h, own = h[one], own[one]
        starts, lengths = _runs(h)
        times = np.repeat(lengths, lengths)
        # a member counts for a set if another set near enough in size has it: the next smaller or larger
        order = np.lexsort((sizes[own], h))
        h, own = h[order], own[order]
        size = sizes[own]
        near = (h[1:] == h[:-1]) & (100 * size[:-1] >= np.uint64(percent) * size[1:])
        many = np.concatenate([[False], near]) | np.concatenate([near, [False]]) if len(h) else np.zeros(0, bool)
        h, own, times = h[many], own[many], times[many].astype(np.uint32)
        # members with the same holders open the same region: a digest of the holders stands for them
        starts, lengths = _runs(h)
        holders = np.add.reduceat(mix(names[own]), starts) if len(h) else h
        group = np.repeat((mix(holders + lengths.astype(np.uint64)) >> np.uint64(32)).astype(np.uint32), lengths)
        return h, own, times, group

    def count(bodies: list[bytes]) -> Iterator[pa.RecordBatch]:
        held, names, sizes, n_sets = [], [], [], 0
        for body in bodies:
            name, n, index, steps, part = _unpacked(body)
            h = np.cumsum(steps)  # ascending, as it was dealt
            h *= np.uint64(parts)
            h += part[0]
            held.append((h, index.astype(np.uint16), n_sets))
            names.append(name)
            sizes.append(n)
            n_sets += len(name)
            del name, n, index, steps
        names, sizes = np.concatenate(names), np.concatenate(sizes)
        # range by range of the hashes, so that the arrays of a whole part are never there at once
        n_ranges = -(-sum(len(h) for h, _, _ in held) // RANGE)
        ends = np.array([(k << MEMBER_BITS) // n_ranges for k in range(n_ranges + 1)], np.uint64)
        cuts = [np.searchsorted(h, ends) for h, _, _ in held]
        found = []
        for k in range(n_ranges):
            h = np.concatenate([h[c[k] : c[k + 1]] for (h, _, _), c in zip(held, cuts, strict=True)])
            own = np.concatenate([index[c[k] : c[k + 1]] + np.uint32(first) for (_, index, first), c in zip(held, cuts, strict=True)])
            found.append(shared(h, own, names, sizes))
        held.clear()
        h, own, times, group = (np.concatenate(c) for c in zip(*found, strict=True))
        found.clear()
        to = names % np.uint64(parts)
        order = np.lexsort((names, to))
        place = np.empty(n_sets, np.uint32)
        place[order] = np.arange(n_sets, dtype=np.uint32)
        ends = np.searchsorted(to[order], np.arange(parts + 1, dtype=np.uint64))  # of the sets dealt to each part
        order = np.argsort(place[own], kind="stable")
        own = own[order]
        ends = np.searchsorted(place[own], ends)
        out = []
        for p in range(parts):
            at = slice(ends[p], ends[p + 1])
            if at.start < at.stop:
                mine = order[at]
                first, runs = _runs(names[own[at]])
                sets = own[at][first]
                out.append((p, _packed(names[sets], sizes[sets], runs.astype(np.uint64), h[mine], times[mine], group[mine])))
        if out:
            yield _rows(out)

    dealt, run = _by_part(blobs, parts, count)
    return dealt.mapInArrow(handing_back(run), BLOB)


_SURVIVOR = "set long, n long, spread double, shared array<bigint>, rare array<bigint>, bits array<bigint>"


def _survivors(blobs: DataFrame, parts: int, percent: int) -> DataFrame:
    """Sets that can link: their shared members, the groups of the rarest of these that any link must
    meet, and ``BITS`` parities of the numbers of shared members by hash."""

    def gather(bodies: list[bytes]) -> Iterator[pa.RecordBatch]:
        cols: list[list[np.ndarray]] = [[], [], [], [], []]
        for body in bodies:
            names, n, runs, h, times, group = _unpacked(body)
            runs = runs.astype(np.int64)
            for c, a in zip(cols, (np.repeat(names, runs), np.repeat(n, runs), h, times, group), strict=True):
                c.append(a)
        name, n, h, times, group = (np.concatenate(c) for c in cols)
        order = np.lexsort((h, times, name))
        name, n, h, times, group = name[order], n[order].astype(np.int64), h[order], times[order], group[order]
        starts, shared = _runs(name)
        size = n[starts]
        fit = 100 * shared >= percent * size
        keep = np.repeat(fit, shared)
        if not fit.any():
            return
        miss = size * (100 - percent) // 100  # members a linked set may lack
        rare = np.maximum(0, miss + 1 - (size - shared))
        rank = np.arange(len(name)) - np.repeat(starts, shared)
        low = keep & (rank < np.repeat(rare, shared))
        owner = np.repeat(np.cumsum(fit) - 1, shared)  # number of the set among those that fit
        opened = np.unique((owner[low].astype(np.uint64) << np.uint64(32)) | group[low])
        n_opened = np.bincount((opened >> np.uint64(32)).astype(np.int64), minlength=int(fit.sum()))
        low_bits, at = h[keep] % np.uint64(BITS), np.concatenate([[0], np.cumsum(shared[fit])[:-1]])
        bits = np.empty((int(fit.sum()), BITS // 64), np.uint64)
        for k in range(BITS // 64):
            one = np.where(low_bits >> np.uint64(6) == k, np.uint64(1) << (low_bits & np.uint64(63)), np.uint64(0))
            bits[:, k] = np.bitwise_xor.reduceat(one, at)
        bits = bits.reshape(-1)
        total = np.add.reduceat(times, starts).astype(np.float64)[fit] / size[fit]
        offsets = lambda x: pa.array(np.concatenate([[0], np.cumsum(x)]), pa.int32())
        longs = lambda x: pa.array(x.astype(np.int64))
        yield pa.RecordBatch.from_arrays(
            [
                longs(name[starts][fit]), longs(size[fit]), pa.array(total),
                pa.ListArray.from_arrays(offsets(shared[fit]), longs(h[keep])),
                pa.ListArray.from_arrays(offsets(n_opened), longs(opened & np.uint64((1 << 32) - 1))),
                pa.ListArray.from_arrays(offsets(np.full(int(fit.sum()), BITS // 64)), longs(bits)),
            ],
            names=["set", "n", "spread", "shared", "rare", "bits"],
        )

    dealt, run = _by_part(blobs, parts, gather)
    return dealt.mapInArrow(handing_back(run), _SURVIVOR)


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (``x, p`` and more) with ``both, either``: exact sizes of intersection and union.

    Members move as little as can be: the written pairs go to the sets if their measured size allows (else both
    are shuffled), and of the other side only the sets that are some pair's ``p``.
    """
    side = lambda k: sets.select(F.col("set").alias(k), F.col("n").alias(f"n_{k}"), F.col("shared").alias(f"s_{k}"))
    both = F.size(F.array_intersect("s_x", "s_p")).cast("long")
    hint = broadcast_hint(pairs)
    pivots = side("p").join(hint(pairs.select("p").distinct()), "p", "left_semi")
    met = side("x").join(hint(pairs), "x").join(pivots, "p").select(*pairs.columns, both.alias("both"), (F.col("n_x") + F.col("n_p")).alias("_n"))
    return met.select(*pairs.columns, "both", (F.col("_n") - F.col("both")).alias("either"))


def _possible(a, b, percent: int):
    """Can two sets (structs with ``n``, ``lone``, ``bits``) be linked? Never false for linked sets.

    Members that no other set has, and bits in which the parities differ, count members of one set only.
    """
    apart = F.aggregate(
        F.arrays_zip(a["bits"].alias("u"), b["bits"].alias("v")), F.lit(0), lambda t, z: t + F.bit_count(z["u"].bitwiseXOR(z["v"]))
    )
    apart = F.greatest(apart + a["lone"] + b["lone"], F.abs(a["n"] - b["n"]))
    return (100 + percent) * apart <= (100 - percent) * (a["n"] + b["n"])


def _roots(sets: DataFrame, percent: int) -> DataFrame:
    """``node, root``: the class of every set that can link, named by its least set.

    Only sets of different classes are compared after the distances to the pivots, and no pair of a region
    twice. Pairs that sizes, lone members, parity bits or the triangle inequality rule out are dropped before
    any members meet. A region is done when it holds no set outside its pivot's class.
    """
    r = 1 - percent / 100
    scratch = Scratch()
    linked = F.col("both") * 100 >= F.col("either") * percent
    # regions hold sets of like size: a set near the lower end of a step also goes to the one below
    step = lambda n: F.floor(F.ln(n) / math.log(STEP))
    steps = F.array_distinct(F.array(step(F.col("n")), step(F.col("n") * (percent / 100 * 0.9999))))
    every = sets.select(F.explode("rare").alias("h"), steps.alias("b"), F.col("set").alias("x"))
    every = every.select("h", F.explode("b").alias("b"), "x").select(F.xxhash64("h", "b").alias("s"), "x")
    brief = F.struct("n", (F.col("n") - F.size("shared")).alias("lone"), "bits").alias("a")
    briefs = scratch.write(sets.select(F.col("set").alias("x"), "spread", brief), "briefs")
    regions = scratch.write(every, "regions")
    sizes = regions.groupBy("s").agg(F.count("*").alias("n_all")).where("n_all > 1")
    members = scratch.write(regions.join(sizes, "s").join(briefs, "x"), "members")
    scratch.drop(regions)

    leaf = members.where(F.col("n_all") <= LEAF).groupBy("s").agg(F.collect_list(F.struct("x", "a")).alias("m"))
    leaf = leaf.select("m", F.explode("m").alias("u")).select(
        F.col("u.x").alias("x"),
        F.explode(F.filter("m", lambda v: (F.col("u.x") < v["x"]) & _possible(F.col("u.a"), v["a"], percent))).alias("v"),
    )
    wide = members.where(F.col("n_all") > LEAF)
    firsts = wide.groupBy("s").agg((-F.max(F.struct("spread", (-F.col("x")).alias("y")))["y"]).alias("p"))
    firsts = scratch.write(firsts, "pivots")
    faced = wide.join(firsts, "s").where("x <> p")
    pairs = scratch.write(leaf.select("x", F.col("v.x").alias("p")).unionByName(faced.select("x", "p")).distinct(), "pairs")
    seen = scratch.write(_compared(pairs, sets), "distances")
    far = seen.select("x", "p", (1 - F.col("both") / F.col("either")).alias("d"))
    rest = scratch.write(faced.join(far, ["x", "p"]).select("s", "x", "spread", "a", "d"), "measured")
    roots = sets.select(F.col("set").alias("node"), F.col("set").alias("root"))
    joins = scratch.write(seen.where(linked).select("x", "p"), "joins")
    roots = _merged(roots, joins, scratch)
    scratch.drop(members, pairs, seen, joins, briefs)

    pivots = PIVOTS
    while True:
        own = firsts.join(roots, firsts.p == roots.node).select("s", F.col("root").alias("p_class"))
        now = rest.join(roots.select(F.col("node").alias("x"), F.col("root").alias("class")), "x").join(own, "s")
        outside = now.where("class <> p_class").groupBy("s").agg(F.count("*").alias("n_out"), F.min("d").alias("lo"), F.max("d").alias("hi"))
        # of the pivot's class stay those that the window of some other set reaches
        reached = f"class <> p_class OR (d >= lo - {r} - 1e-9 AND d <= hi + {r} + 1e-9)"
        now = scratch.write(now.join(outside, "s").where(reached).drop("lo", "hi"), "facing")
        scratch.drop(rest)
        if now.isEmpty():
            scratch.drop(now, firsts)
            return roots
        rank = F.row_number().over(Window.partitionBy("s").orderBy(F.desc("spread"), "x"))
        picks = now.where("class <> p_class").withColumn("rank", rank).where(F.col("rank") <= pivots)
        picks = picks.select("s", F.col("x").alias("p"), F.col("class").alias("q_class"), F.col("a").alias("q_a"), F.col("d").alias("q_d"))
        picks = scratch.write(picks, "picks")
        met = (now["s"] == picks["s"]) & (F.col("class") != F.col("q_class")) & (F.abs(F.col("d") - F.col("q_d")) <= r + 1e-9)
        pairs = now.join(picks, met & _possible(F.col("a"), F.col("q_a"), percent)).select("x", "p", "class", "q_class").distinct()
        pairs = scratch.write(pairs, "pairs")
        seen = scratch.write(_compared(pairs, sets), "distances")
        joins = scratch.write(seen.where(linked).select(F.col("class").alias("x"), F.col("q_class").alias("p")).distinct(), "joins")
        roots = _merged(roots, joins, scratch)
        rest = now.where(F.col("n_out") > pivots).join(picks.select("s", F.col("p").alias("x")), ["s", "x"], "left_anti")
        rest = scratch.write(rest.select("s", "x", "spread", "a", "d"), "measured")
        scratch.drop(now, picks, pairs, seen, joins)
        pivots = min(16 * pivots, MOST_PIVOTS)  # sets that resist are few or far from all: face them together


def _merged(roots: DataFrame, joins: DataFrame, scratch: Scratch) -> DataFrame:
    """``roots`` after the classes ``x, p`` of each row of ``joins`` became one."""
    if joins.isEmpty():
        return roots
    found = components(joins)
    to = found.select(F.col("node").alias("root"), F.col("root").alias("to"))
    new = scratch.write(roots.join(to, "root", "left").select("node", F.coalesce("to", "root").alias("root")), "roots")
    scratch.drop(roots)
    return new


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of a link: the least node it is connected with."""
    scratch = Scratch()
    ways = scratch.write(links.select("x", "p").unionByName(links.select(F.col("p").alias("x"), F.col("x").alias("p"))), "ways")
    now = scratch.write(ways.groupBy(F.col("x").alias("node")).agg(F.least(F.min("p"), F.col("x")).alias("root")), "roots")
    while True:
        low = ways.join(now, ways.p == now.node).groupBy("x").agg(F.min("root").alias("low"))
        step = now.join(low, now.node == low.x).select("node", F.col("root").alias("was"), F.least("root", "low").alias("root"))
        step = scratch.write(step, "roots")
        jump = step.select(F.col("node").alias("at"), F.col("root").alias("further"))
        after = scratch.write(
            step.join(jump, step.root == jump["at"]).select("node", "was", F.least("root", "further").alias("root")), "roots"
        )
        scratch.drop(step, now)
        if after.where("root <> was").isEmpty():
            scratch.drop(ways)
            return after.select("node", "root")
        now = after


def classes(docs: DataFrame, percent: int = 75, key: str = "doc_id") -> DataFrame:
    """``key, n_shingles, component_id`` for every row of ``docs``."""
    has_column(docs, key, "text")
    named = materialised(set_names(docs, key), "names")
    members = named.where("n > 0").select("set", "n").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    parts = max(1, -(-members // PART))
    blobs = _members(docs, parts)
    scratch = Scratch()
    sets = scratch.write(_survivors(_support(blobs, parts, percent), parts, percent), "survivors")
    roots = _roots(sets, percent)
    least = named.where("n > 0").groupBy("set").agg(F.min(key).alias("least"))
    rooted = materialised(
        least.join(roots, least.set == roots.node, "left").select("set", F.coalesce("root", "set").alias("root"), "least"), "rooted"
    )
    scratch.drop(sets)
    of_root = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_set = rooted.join(of_root, "root").select(F.col("set"), "component_id")
    full = named.where("n > 0").join(of_set, "set").select(key, F.col("n").alias("n_shingles"), "component_id")
    empty = named.where("n = 0").select(key, F.col("n").alias("n_shingles"), F.col(key).alias("component_id"))
    return full.unionByName(empty)


def deduplicated(docs: DataFrame, percent: int = 75) -> DataFrame:
    """``docs`` with one row of each class: that of the least ``doc_id``, the first of equal ids."""
    has_column(docs, "doc_id", "text")
    placed = set_aside(docs, "doc_id", "text").withColumn("_place", F.monotonically_increasing_id())
    # rows ranked by (doc_id, place) without a global sort: the pair is compared as a struct
    grouped = classes(placed.select("_place", "text"), percent, key="_place")
    ids = placed.select("_place", F.col("doc_id").alias("_id"))
    best = (
        grouped.select("_place", "component_id")
        .join(ids, "_place")
        .groupBy("component_id")
        .agg(F.min(F.struct(F.col("_id").isNull(), F.col("_id"), F.col("_place")))["_place"].alias("_place"))
    )
    keep = materialised(best.select("_place"), "representatives")
    gone = materialised(ids.select("_place").join(keep, "_place", "left_anti"), "others")
    # texts stay where they are if the fewer of both kinds of places fit a broadcast
    fewer, how = (gone, "left_anti") if gone.count() <= keep.count() else (keep, "left_semi")
    stay = placed.join(broadcast_hint(fewer)(fewer), "_place", how)
    return stay.select(*brought_back(docs.columns, doc_id=F.col("doc_id"), text=F.col("text")))
