"""Runs of periodic words in texts, by multi-scale minimizers.

A run is a stretch of words of smallest period ``q`` and length at least ``max(6, 4 q)`` that cannot
be extended to either side with that period. Words are compared as they stand.

Texts of a task are laid end to end, each word as its number, with a number of its own between two
texts, so that no stretch spans two of them. Periods up to ``SHORT`` are found by direct lag scans:
stretches of positions equal to the position ``q`` further on. Longer periods go by scales
``L = 2 SHORT, 4 SHORT, ...``, each for the periods in ``(L / 2, L]``: in every window of ``L / 2``
positions the one whose next ``L`` words have the smallest hash is the window's minimizer. A run is at
least four periods long, so it holds two windows a period apart with equal contents, whose minimizers
lie a period apart; and the same ``L >= q`` words do not recur in between. Equal neighbouring
minimizers at a distance of the scale are therefore seeds, and every seed is extended to both sides by
comparing words. A stretch found with several periods keeps the smallest; the others are its multiples.

Hashes only propose (64 bits, doubled from scale to scale); what is reported was compared word by word.
Work is near ``n log n`` words; texts stay whole, one text is always within one task, and a task holds
a bounded slice of texts (or one text) at a time.

Defined cases: NULL or empty text: no words, no runs, the digest of the empty string. Repeated rows and
ids give a row each. A NULL id gives a row; what depends on the id (:func:`tandem_repeated`) leaves its
text alone. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from fractions import Fraction
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.words import has_column

SHORT = 16
SLICE_BYTES = 1 << 21
LEAST, TIMES = 6, 4

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class _Numbers(dict):
    """Number of each word, in order of first sight."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _A
    return x ^ (x >> np.uint64(29))


def _sliding(x: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """Smallest (or largest) of every ``width`` neighbours; ``width`` is a power of two."""
    step = 1
    while step < width:
        x = pick(x[:-step], x[step:])
        step *= 2
    return x


def _stretches(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each group of consecutive numbers in a sorted array."""
    cut = np.flatnonzero(np.diff(at) != 1)
    return at[np.concatenate([[0], cut + 1])], at[np.concatenate([cut, [len(at) - 1]])]


def _short(words: np.ndarray, found: dict[tuple[int, int], int]) -> None:
    for q in range(1, min(SHORT, len(words) - 1) + 1):
        at = np.flatnonzero(words[q:] == words[:-q])
        if not len(at):
            continue
        first, last = _stretches(at)
        long = last - first + 1 >= max(LEAST, TIMES * q) - q
        for s, e in zip(first[long].tolist(), last[long].tolist(), strict=True):
            found.setdefault((s, e + 1 + q), q)


def _equal_run(words: np.ndarray, x: int, q: int) -> tuple[int, int]:
    """The stretch around ``x`` where words ``q`` apart are equal: first position and end."""
    lo, step = x, 64
    while lo > 0:
        a = max(0, lo - step)
        off = np.flatnonzero(words[a:lo] != words[a + q : lo + q])
        if len(off):
            lo = a + int(off[-1]) + 1
            break
        lo, step = a, step * 2
    hi, step, end = x, 64, len(words) - q
    while hi < end:
        b = min(end, hi + step)
        off = np.flatnonzero(words[hi:b] != words[hi + q : b + q])
        if len(off):
            hi += int(off[0])
            break
        hi, step = b, step * 2
    return lo, hi


def _scale(words: np.ndarray, grams: np.ndarray, length: int, found: dict[tuple[int, int], int]) -> None:
    """Runs of periods in ``(length / 2, length]``; ``grams[i]`` is the hash of the ``length`` words from ``i``."""
    width = length // 2
    if len(grams) < width:
        return
    least = _sliding(grams, width, np.minimum)
    padded = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
    at = np.flatnonzero(_sliding(padded, width, np.maximum) == grams)  # smallest of a window that holds it
    order = at[np.argsort(grams[at], kind="stable")]
    near, far = order[:-1], order[1:]
    seed = (grams[near] == grams[far]) & (far - near > width) & (far - near <= length)
    done: dict[int, int] = {}  # period: end of its last stretch
    for x, q in sorted(zip(near[seed].tolist(), (far - near)[seed].tolist(), strict=True)):
        if x < done.get(q, 0):
            continue
        lo, hi = _equal_run(words, x, q)
        done[q] = max(hi, x + 1)
        if hi + q - lo >= max(LEAST, TIMES * q):
            found[lo, hi + q] = min(q, found.get((lo, hi + q), q))


def runs_of(words: np.ndarray, ends: np.ndarray) -> list[tuple[int, int, int]]:
    """All runs ``(start, end, period)`` of word numbers laid end to end, by start and period.

    ``ends`` are the ends of the texts, each text's last position holding a number of its own.
    """
    found: dict[tuple[int, int], int] = {}
    if len(words) < LEAST:
        return []
    _short(words, found)
    length = 2 * SHORT
    sizes = np.diff(ends, prepend=0)
    while True:
        keep = sizes > TIMES * (length // 2)  # texts that can hold a run of the scale
        if not keep.any():
            break
        mask = np.repeat(keep, sizes)
        where = np.flatnonzero(mask)
        part, part_found = words[mask], {}
        grams, have = _mix(part.astype(np.uint64) + _B), 1
        while have < length and len(grams) > have:
            grams = _mix(grams[:-have] * _A + grams[have:] * _B + np.uint64(have))
            have *= 2
        if have == length:
            _scale(part, grams, length, part_found)
        for (s, e), q in part_found.items():
            span = int(where[s]), int(where[e - 1]) + 1
            found[span] = min(q, found.get(span, q))
        length *= 2
    return sorted((s, e, q) for (s, e), q in found.items())


def _report(words: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
    """Output columns of one text."""
    if not runs:
        return 0, None, None, None, None, hashlib.sha256(b"").hexdigest(), hashlib.sha256(b" ".join(words)).hexdigest()
    s, e, q = min(runs, key=lambda r: (-Fraction(r[1] - r[0], r[2]), r[0], r[2]))
    listed = "".join(f"{a},{b - a},{p}\n" for a, b, p in runs)
    edge = np.zeros(len(words) + 1, np.int64)
    for a, b, p in runs:
        edge[a + p] += 1
        edge[b] -= 1
    stays = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
    collapsed = b" ".join([words[k] for k in stays.tolist()])
    return (
        len(runs), s, e - s, q, 1000 * (e - s) // q,
        hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(collapsed).hexdigest(),
    )


COLUMNS = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
_TYPES = [pa.int64()] * 5 + [pa.string()] * 2


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts come to about ``SLICE_BYTES``."""
    size = np.array([s or 0 for s in pc.binary_length(batch.column(1)).to_pylist()], np.int64)
    ends, at = np.cumsum(size), 0
    while at < len(size):
        to = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE_BYTES, side="right"))
        to = max(to, at + 1)
        yield at, to
        at = to


def periodic_runs(
    docs: DataFrame, text: str = "text", row_id: str = "doc_id",
    rewrite: Callable[[object, int], np.ndarray | None] | None = None,
) -> DataFrame:
    """One row per document: the id and ``COLUMNS``: number of runs, the run repeated most often (start
    in words, length, period, thousandths of its exponent), and digests of all runs and of the text
    without repetitions.

    ``rewrite(id, n)`` may give, for a document of ``n`` words, the word number to stand at each place.
    """
    has_column(docs, text, row_id)
    plain = docs.select(F.col(row_id).alias("_id"), F.col(text).alias("_text"))
    kind = plain.schema["_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to in _slices(batch):
                ids = batch.column(0).slice(at, to - at)
                texts = batch.column(1).slice(at, to - at).cast(pa.large_binary()).to_pylist()
                numbers, all_words, parts = _Numbers(), [], []
                for k, (i, t) in enumerate(zip(ids.to_pylist(), texts, strict=True)):
                    words = t.split() if t else []
                    order = rewrite(i, len(words)) if rewrite else None
                    if order is not None:
                        words = [words[j] for j in order.tolist()]
                    all_words.append(words)
                    parts.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
                    parts.append(np.array([-1 - k]))
                ends = np.cumsum([len(w) + 1 for w in all_words])
                runs: list[list[tuple[int, int, int]]] = [[] for _ in all_words]
                for s, e, q in runs_of(np.concatenate(parts), ends):
                    doc = int(np.searchsorted(ends, s, side="right"))
                    first = int(ends[doc - 1]) if doc else 0
                    runs[doc].append((s - first, e - first, q))
                rows = [_report(w, sorted(r, key=lambda x: (x[0], x[2]))) for w, r in zip(all_words, runs, strict=True)]
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)]
                yield pa.RecordBatch.from_arrays([ids, *columns], ["_id", *[c.split()[0] for c in COLUMNS.split(", ")]])

    return plain.mapInArrow(work, f"_id {kind}, {COLUMNS}").withColumnRenamed("_id", row_id)


def tandem_repeated(row_id: object, n: int) -> np.ndarray | None:
    """For every tenth id (by its checksum) the words from a place on become repeats of a first piece.

    With ``h`` the CRC-32 of the decimal id and ``g = h // 10``: if ``h`` ends in 0, place ``i >= a = g % n``
    takes word ``a + (i - a) % p``, ``p = 1 + (n - a) // (3 + g % 8)``.
    """
    if row_id is None or not n:
        return None
    g, last = divmod(crc32(str(row_id).encode()), 10)
    if last:
        return None
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % p)
