"""Periodic runs against a scan of all periods, word by word."""

from __future__ import annotations

import hashlib
import random
from fractions import Fraction
from zlib import crc32

import numpy as np
import pytest

from tests.conftest import bag
from tidewheel.llm import periods


def brute_runs(words):
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        s = 0
        while s + q < n:
            e = s
            while e + q < n and words[e] == words[e + q]:
                e += 1
            if e > s and e + q - s >= max(6, 4 * q):
                piece = words[s : e + q]
                if not any(all(piece[k] == piece[k + d] for k in range(len(piece) - d)) for d in range(1, q)):
                    found[s, e + q] = q
            s = e + 1
    return sorted(((s, e, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_row(i, text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if i is not None and n and crc32(str(i).encode()) % 10 == 0:
        g = crc32(str(i).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (k - a) % p] for k in range(a, n)]
    runs = brute_runs(words)
    best = min(runs, key=lambda r: (-Fraction(r[1] - r[0], r[2]), r[0], r[2])) if runs else None
    gone = {k for s, e, q in runs for k in range(s + q, e)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (
        i, len(runs), *((best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4),
        sha("".join(f"{s},{e - s},{q}\n" for s, e, q in runs)), sha(" ".join(w for k, w in enumerate(words) if k not in gone)),
    )


def planted(rnd, n, letters, periods_from):
    words = [rnd.choice(letters) for _ in range(n)]
    for _ in range(rnd.randrange(4)):
        q = rnd.choice(periods_from)
        s, length = rnd.randrange(n), q * rnd.randrange(3, 7) + rnd.randrange(q)
        unit = [rnd.choice(letters) for _ in range(q)]
        piece = [unit[k % q] for k in range(length)]
        words[s : s + length] = piece
    return words


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_many_texts_at_once(seed):
    rnd = random.Random(seed)
    letters = [["a", "b"], ["a", "b", "c", "d"], [f"w{k}" for k in range(40)]][seed % 3]
    texts = [planted(rnd, rnd.randrange(0, 500), letters, [1, 2, 3, 5, 15, 16, 17, 24, 31, 32, 33, 48, 63, 64, 65, 90]) for _ in range(25)]
    numbers = periods._Numbers()
    flat, ends = [], []
    for k, words in enumerate(texts):
        flat += [numbers[w] for w in words] + [-1 - k]
        ends.append(len(flat))
    got = periods.runs_of(np.array(flat), np.array(ends))
    want, first = [], 0
    for words, end in zip(texts, ends, strict=True):
        want += [(s + first, e + first, q) for s, e, q in brute_runs(words)]
        first = end
    assert got == sorted(want) and any(q > 32 for _, _, q in want)


def test_whole_table(spark):
    rnd = random.Random(11)
    rows = [(k, " ".join(planted(rnd, rnd.randrange(1, 120), ["a", "b", "ü"], [1, 2, 4, 17, 20]))) for k in range(120)]
    rows += [(200, None), (201, ""), (202, " \n\t "), (203, "x " * 50), (203, "x " * 50), (None, "p q " * 9), (204, "a b a b"), (205, "one")]
    docs = spark.createDataFrame([(i, t, 1, "s", 2) for i, t in rows], "doc_id long, text string, start int, period string, _id int")
    got = bag(periods.periodic_runs(docs, rewrite=periods.tandem_repeated))
    key = lambda r: tuple((v is not None, v) for v in r)
    assert got == sorted((brute_row(i, t) for i, t in rows), key=key)
    assert periods.periodic_runs(docs.limit(0)).count() == 0


def test_long_text_and_long_period(spark):
    rnd = random.Random(2)
    unit = [f"w{rnd.randrange(5000)}" for _ in range(7001)]
    words = [f"v{k}" for k in range(900)] + unit * 5 + unit[:17] + ["end"]
    docs = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    row = periods.periodic_runs(docs).first()
    assert (row.n_runs, row.start, row.length, row.period) == (1, 900, 7001 * 5 + 17, 7001)


def test_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    short = docs.where("length(text) < 4000 OR text IS NULL")
    got = bag(periods.periodic_runs(short, rewrite=periods.tandem_repeated))
    assert got == sorted((brute_row(i, t) for i, t in short.collect()), key=lambda r: tuple((v is not None, v) for v in r))
    assert sum(r[1] for r in got) > 5
