"""Sets of hashed word shingles of many texts at once, straight from Arrow's byte buffers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WORDS = 5
BITS = 48  # a set's members; the other 16 bits number the texts of a slice
SLICE_BYTES = 1 << 19  # some ten arrays of eight times as many bytes are in use at once
SLICE_TEXTS = 1 << 12

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE = np.random.default_rng(5).integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_STEP = np.uint64(0xD1342543DE82EF95)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit values over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _BASE_INVERSE)):
            steps = np.full(n, base)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers[0][:n], _powers[1][:n]


def _set_members(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Members of all texts, sorted within each text, and their number per text."""
    n_texts = len(offsets) - 1
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(n_texts, np.int64)
    space = _SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets[:-1]] = True  # a text's first byte; the end for empty texts at the end
    first[-1] = True
    before = np.concatenate([[True], space[:-1]]) | first[:-1]
    after = np.concatenate([space[1:], [True]]) | first[1:]
    starts, ends = np.flatnonzero(~space & before), np.flatnonzero(~space & after)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(n_texts, np.int64)
    power, inverse = _power(len(data))
    sums = np.cumsum(_BYTE[_LOWER[data]] * power)
    word = (sums[ends] - np.where(starts > 0, sums[starts - 1], np.uint64(0))) * inverse[starts]
    word = mix(word + (ends - starts + 1).astype(np.uint64))
    text = np.searchsorted(offsets, starts, side="right") - 1
    n_words = np.bincount(text, minlength=n_texts)
    members, owners = [], []
    if len(word) >= WORDS:
        joined = word[: len(word) - WORDS + 1].copy()
        for k in range(1, WORDS):
            joined = joined * _STEP + word[k : len(word) - WORDS + 1 + k]
        whole = text[: len(joined)] == text[WORDS - 1 :]
        members.append(mix(joined[whole]))
        owners.append(text[: len(joined)][whole])
    firsts = np.concatenate([[0], np.cumsum(n_words)[:-1]])
    short = np.flatnonzero((n_words > 0) & (n_words < WORDS))
    if len(short):  # the whole sequence as one member, told apart by its length
        joined = word[firsts[short]].copy()
        for k in range(1, WORDS - 1):
            more = n_words[short] > k
            joined[more] = joined[more] * _STEP + word[firsts[short][more] + k]
        members.append(mix(joined + n_words[short].astype(np.uint64)))
        owners.append(short)
    shift = np.uint64(64 - BITS)
    keys = (np.concatenate(owners).astype(np.uint64) << np.uint64(BITS)) | (np.concatenate(members) >> shift)
    keys.sort()
    keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])]
    return keys & np.uint64((1 << BITS) - 1), np.bincount((keys >> np.uint64(BITS)).astype(np.int64), minlength=n_texts)


def shingle_sets(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Slices of the texts: ``(first, members, sizes, names)``.

    ``members`` lie text by text, sorted; ``sizes`` count them; ``names`` are 64-bit fingerprints of
    the sets, equal for equal sets, 0 for the empty one.
    """
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    body = texts.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        to = int(np.searchsorted(ends, ends[at] + SLICE_BYTES, side="right")) - 1
        to = max(at + 1, min(to, at + SLICE_TEXTS, len(texts)))
        members, sizes = _set_members(data[ends[at] : ends[to]], ends[at : to + 1] - ends[at])
        names = np.zeros(to - at, np.uint64)
        filled = np.flatnonzero(sizes)
        if len(filled):
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])[filled]
            names[filled] = mix(np.add.reduceat(mix(members + _BASE), starts) + sizes[filled].astype(np.uint64)) | np.uint64(1)
        yield at, members, sizes, names
        at = to
