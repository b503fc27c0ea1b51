"""Pack documents into sequences of fixed length by bin completion.

Documents are encoded and cut only where longer than a sequence. Pieces are packed in groups of a
bounded number, inside the task that encoded them, so ids do not move. A group starts from a
best-fit-decreasing solution (the incumbent). If that uses more sequences than a lower bound, the
group is searched by branch and bound: take the largest piece left, go through the fillings of the
rest of its sequence that no exchange betters, and give up a branch once its waste is above what one
sequence less than the incumbent leaves. The search holds counts per length, so a step costs the same
in a large group, and forms fillings as they are asked for, so none is left out. First the emptiest sequences of the
incumbent are searched for a solution with one less, more of them at a time (few large pieces and many small ones lie there),
then the whole group. A search ends after a number of steps that grows with its sequences, and keeps the incumbent.
Sequences that stay too empty at the end of a task are opened, and their pieces packed again in
larger groups across tasks, once.

Defined results: NULL is the empty text and gives its end id alone, so every row has a piece.
Repeated rows are packed like others. An empty table gives no rows. Extra columns are dropped;
``doc_id`` may be NULL or repeated.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import accumulate, islice

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.tokens import shared_encoder, slices
from tidewheel.llm.words import has_column
from tidewheel.llm.workers import handing_back
from tidewheel.sources.sinks import materialised

GROUP = 8192
STEPS = 2_000
FULL = 0.98
PIECE = "doc_id long, piece int, start long, length long, ids binary"
PACKED = f"{PIECE}, sequence_id long, offset long, loose boolean"
_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
     ("sequence_id", pa.int64()), ("offset", pa.int64()), ("loose", pa.bool_())]
)


def best_fit(lengths: list[int], size: int) -> list[list[int]]:
    """Best-fit decreasing: each piece, longest first, goes where the least room is left."""
    room: list[tuple[int, int]] = []
    bins: list[list[int]] = []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        k = bisect_left(room, (lengths[i], -1))
        if k < len(room):
            left, b = room.pop(k)
            bins[b].append(i)
        else:
            left, b = size, len(bins)
            bins.append([i])
        if left > lengths[i]:
            insort(room, (left - lengths[i], b))
    return bins


def least_bins(lengths: list[int], size: int) -> int:
    """A lower bound: tokens by size, and pieces above a half with what of the rest cannot go beside them."""
    asc = sorted(lengths)
    sums = [0, *accumulate(asc)]
    n, half = len(asc), bisect_right(asc, size // 2)
    least = -(-sums[n] // size)
    for small in {0, *asc[:half]}:
        low, high = bisect_left(asc, small), max(half, bisect_right(asc, size - small))
        room = (high - half) * size - (sums[high] - sums[half])  # beside pieces that leave room for a small one
        least = max(least, n - half + max(0, -(-(sums[half] - sums[low] - room) // size)))
    return least


class Pieces:
    """Counts of the lengths left, and a bit for each length that occurs."""

    def __init__(self, lengths: list[int]):
        self.count = Counter(lengths)
        self.bits = sum(1 << x for x in self.count)
        self.steps, self.most = 0, float("inf")

    def longest(self, most: int) -> int:
        """The longest length left up to ``most``; 0 if there is none."""
        return (self.bits & ((2 << most) - 1)).bit_length() - 1 if most > 0 and self.bits & ((2 << most) - 1) else 0

    def take(self, length: int, n: int) -> None:
        self.count[length] -= n
        if self.count[length] == 0:
            self.bits &= ~(1 << length)

    def put(self, length: int, n: int) -> None:
        self.count[length] += n
        self.bits |= 1 << length

    def fillings(self, room: int, spare: int) -> Iterator[tuple[int, list[tuple[int, int]]]]:
        """``left, [(length, n)]``: fillings that leave at most ``spare`` of ``room``, longest pieces first.

        Left out are only those that another is as good as: where a piece more fits, where a longer
        piece fits in place of one, or where one piece fits in place of all that follow it.
        """
        if not self.longest(room):
            if room <= spare:
                yield room, []
            return
        yield from self._fillings(room, room, spare, 0, [])

    def _fillings(self, room: int, most: int, spare: int, skipped: int, chosen: list[tuple[int, int]]):
        least = (self.bits & -self.bits).bit_length() - 1
        x = self.longest(min(room, most))
        while x and self.steps < self.most:
            have, fit = self.count[x], room // x
            may = spare if not skipped else min(spare, skipped - x - 1)  # else the skipped one in place of x
            for n in range(min(have, fit), 0, -1):
                self.steps += 1
                left = room - n * x
                more = n < have and left >= x  # one more x would fit
                allowed = min(may, left - x - 1) if more else may
                if allowed < 0:
                    continue
                chosen.append((x, n))
                below = min(left, x - 1)
                if self.longest(below):
                    after = min(below, left - least) if more else below
                    if self.longest(after):
                        yield from self._fillings(left, after, allowed, x if n < have else skipped, chosen)
                elif not more and left <= allowed and not (skipped and skipped <= left):
                    yield left, list(chosen)
                chosen.pop()
            spare = min(spare, room - x - 1)  # what follows must hold more than x alone
            if spare < 0:
                return
            skipped = x
            x = self.longest(min(x - 1, room - least))


def _fullest(found: Iterator, n: int = 8) -> Iterator:
    """All of ``found``, ``n`` at a time with the fullest first."""
    while part := sorted(islice(found, n), key=lambda f: (f[0], sum(k for _, k in f[1]))):
        yield from part


def bin_completion(lengths: list[int], size: int, steps: int = STEPS) -> list[list[int]]:
    """As few bins as found: best fit, then branch and bound while that is above the lower bound."""
    best = best_fit(lengths, size)
    need = least_bins(lengths, size)
    while len(best) > need:
        fewer = _emptiest_searched(best, lengths, size, steps)
        if fewer is None:
            return _searched(lengths, size, len(best), need, steps) or best
        best = fewer
    return best


def _emptiest_searched(best: list[list[int]], lengths: list[int], size: int, steps: int) -> list[list[int]] | None:
    """``best`` with one bin less by another filling of its emptiest bins, or ``None``."""
    order = sorted(best, key=lambda b: sum(lengths[i] for i in b))
    waste = list(accumulate(size - sum(lengths[i] for i in b) for b in order))
    n = bisect_left(waste, size) + 1  # the fewest that could do with one less
    while n < len(order):
        own = [i for b in order[:n] for i in b]
        theirs = [lengths[i] for i in own]
        if least_bins(theirs, size) < n and (found := _searched(theirs, size, n, n - 1, max(1, steps // 5))):
            return order[n:] + [[own[k] for k in b] for b in found]
        n *= 2
    return None


def _searched(lengths: list[int], size: int, fewest: int, need: int, steps: int) -> list[list[int]] | None:
    """Fewer than ``fewest`` bins by branch and bound, ``need`` at best; ``None`` if none is found."""
    total, solution = sum(lengths), None
    pieces = Pieces(lengths)
    most = pieces.most = 50 * steps + 256 * fewest  # formed fillings; a first descent takes a share for each bin
    path: list[tuple[int, Iterator]] = []  # per open bin its longest piece and the fillings not yet tried
    filled: list[tuple[int, list[tuple[int, int]]]] = []
    waste = 0

    def opened() -> None:
        head = pieces.longest(size)
        pieces.take(head, 1)
        path.append((head, _fullest(pieces.fillings(size - head, (fewest - 1) * size - total - waste))))

    opened()
    while path and pieces.steps < most:
        if len(filled) == len(path):  # back from a branch: undo its filling
            left, chosen = filled.pop()
            waste -= left
            for x, n in chosen:
                pieces.put(x, n)
        step = next(path[-1][1], None)
        if step is None:
            pieces.put(path.pop()[0], 1)
            continue
        left, chosen = step
        pieces.steps += 1
        filled.append(step)
        waste += left
        for x, n in chosen:
            pieces.take(x, n)
        if waste > (fewest - 1) * size - total:
            continue
        if pieces.bits:
            opened()
            continue
        fewest, solution = len(path), [[(h, 1), *f] for (h, _), (_, f) in zip(path, filled, strict=True)]
        if fewest <= need:
            break
    if solution is None:
        return None
    places = defaultdict(list)
    for i in range(len(lengths) - 1, -1, -1):
        places[lengths[i]].append(i)
    return [[places[x].pop() for x, n in b for _ in range(n)] for b in solution]


def _pack(rows: list[tuple], size: int, base: int) -> tuple[pa.RecordBatch, int]:
    """Packed rows of one group, sequences numbered from ``base``, and the next number."""
    lengths = [r[3] for r in rows]
    full = [i for i, n in enumerate(lengths) if n == size]
    part = [i for i, n in enumerate(lengths) if n < size]
    bins = [[i] for i in full] + [[part[k] for k in b] for b in bin_completion([lengths[i] for i in part], size)]
    out: list[tuple] = []
    for b in bins:
        at, loose = 0, sum(lengths[i] for i in b) < size * FULL
        for i in b:
            out.append((*rows[i], base, at, loose))
            at += lengths[i]
        base += 1
    columns = list(zip(*out, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW, strict=True)], schema=_ARROW), base


def _grouped(rows: Iterator[tuple], size: int, number: int) -> Iterator[pa.RecordBatch]:
    group: list[tuple] = []
    for row in rows:
        group.append(row)
        if len(group) >= GROUP:
            done, number = _pack(group, size, number)
            group = []
            yield done
    if group:
        yield _pack(group, size, number)[0]


def packed(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 0) -> DataFrame:
    """Rows ``doc_id, piece, start, length, ids, sequence_id, offset``; ``ids`` are the piece's tokens."""
    has_column(docs, "doc_id", "text")
    end = int(end_id).to_bytes(4, "little")

    def pieces(batches):
        encoder = shared_encoder(tokenizer)
        for part in slices(batches):
            docs, texts = part.column(0).to_pylist(), part.column(1).to_pylist()
            for doc, ids in zip(docs, encoder.encode(texts), strict=True):
                ids += end
                for piece, at in enumerate(range(0, len(ids) // 4, size)):
                    cut = ids[4 * at : 4 * (at + size)]
                    yield doc, piece, at, len(cut) // 4, cut

    def encode_and_pack(batches):
        return _grouped(pieces(batches), size, TaskContext.get().partitionId() << 40)

    first = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(handing_back(encode_and_pack), PACKED)
    return _repacked(materialised(first, "packed"), size)


def _repacked(first: DataFrame, size: int) -> DataFrame:
    """Open the sequences below ``FULL`` and pack their pieces again in groups across tasks."""

    def rows(batches):
        for batch in batches:
            yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)

    def pack_again(batches):
        return _grouped(rows(batches), size, (1 << 62) + (TaskContext.get().partitionId() << 40))

    opened = first.where("loose").select("doc_id", "piece", "start", "length", "ids")
    groups = max(1, -(-opened.count() // GROUP))
    again = opened.repartition(groups, F.xxhash64("doc_id", "piece", "ids")).mapInArrow(handing_back(pack_again), PACKED)
    return first.where("NOT loose").unionByName(again).drop("loose")
