"""Licence notices inside prose, against counting in plain Python."""

from __future__ import annotations

import random
import re

import pytest

from tidewheel.llm import licences


def flat(text):
    return [w for w in re.split(r"[ \n]+", re.sub(r"[^\w.+\n]+|_|\.(?![0-9])", " ", text.lower())) if w]


def pairs(words):
    return [" ".join(words[i : i + 2]) for i in range(max(1, len(words) - 1))] if words else []


def dice(a, b):
    return 2 * len(a & b) / (len(a) + len(b))


def expected(text):
    """Licences of a text, with the best window where nothing larger shows one."""
    sets = {(name, n): set(pairs(flat(t))) for name, ts in licences.TEMPLATES.items() for n, t in enumerate(ts)}
    found = set()
    lines = text.split("\n")
    passages = [line for line in lines if flat(line)]
    paragraphs = [p for p in re.split(r"\n *\n[ \n]*", "\n".join(re.sub(r"[^\w.+\n]+|_|\.(?![0-9])", " ", x.lower()) for x in lines))]
    for p in [*passages, *paragraphs, text]:
        own = set(pairs(flat(p)))
        scores = {k: dice(own, b) for k, b in sets.items()} if own else {}
        good = [(-s, *k) for k, s in scores.items() if s >= 0.8]
        if good:
            found.add(min(good)[1])
    out = {(name, None) for name in found}
    places = pairs(flat(text))
    for name in licences.TEMPLATES:
        best = [
            (-len(b & set(places[i : i + len(b)])) / len(b), i)
            for (n, _), b in sets.items() if n == name and name not in found for i in range(len(places))
            if places[i] in b and len(b & set(places[i : i + len(b)])) >= 0.8 * len(b) - 1e-9
        ]
        if best:
            out.add((name, min(best)[1]))
    return out


def scanned(spark, texts):
    rows = licences.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    out = {k: set() for k in range(len(texts))}
    for r in rows:
        out[r.doc_id].add((r.licence, r.place if r.part == "window" else None))
    return out, rows


def test_notices_that_share_a_line(spark):
    texts = [
        "Copyright 2024 Jane Roe. Licensed under the MIT License.",
        "This file is licensed under the Apache License, Version 2.0 (see LICENSE).",
        "Copyright (c) 2024 Foo Inc. All rights reserved.",
        "The code below is licensed under the Apache License,\nVersion 2.0.",
        "A licence is a permission. The rights of the author are reserved to the author of the software.",
        "Licensed under the MIT License.\nAs said, it is licensed under the MIT License, all of it.",
    ]
    got, rows = scanned(spark, texts)
    assert [{name for name, _ in got[k]} for k in range(6)] == [{"MIT"}, {"Apache-2.0"}, {"Proprietary"}, {"Apache-2.0"}, set(), {"MIT"}]
    assert [r.part for r in rows if r.doc_id == 5] == ["line"]  # the licence shows as a line, so no window is added
    assert got == {k: expected(t) for k, t in enumerate(texts)}


@pytest.mark.parametrize("seed", [1, 2])
def test_random_notices_in_prose(spark, seed):
    rng = random.Random(seed)
    common = "of the to any this software and in a work is under license version rights or code file".split()
    prose = lambda n: " ".join(rng.choice(common) if rng.random() < 0.5 else f"w{rng.randrange(500)}" for _ in range(n))
    texts = []
    for _ in range(60):
        words = rng.choice([t for ts in licences.TEMPLATES.values() for t in ts]).split(" ")
        for _ in range(rng.choice([0, 0, 1, len(words) // 12, len(words) // 6])):
            words[rng.randrange(len(words))] = rng.choice(["some", "other", "the"])
        for at in range(9, len(words), rng.choice([7, 12, 1000])):
            words[at] += rng.choice(["\n", "", ".\n"])
        texts.append(f"{prose(rng.randrange(30))} {' '.join(words)} {prose(rng.randrange(30))}")
    texts += [prose(300), prose(1), texts[0] + "\n" + texts[1], "reserved", "rights reserved"]
    got, _ = scanned(spark, texts)
    assert got == {k: expected(t) for k, t in enumerate(texts)} and sum(bool(v) for v in got.values()) > 25


def test_repeated_rows_and_long_text(spark):
    text = "see note: all rights reserved, they say. " + "of the software " * 30000
    rows = licences.scan(spark.createDataFrame([(1, text), (1, text), (None, text)], "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.part, r.place, r.licence) for r in rows) == [(0, "window", 2, "Proprietary"), (1, "window", 2, "Proprietary"), (1, "window", 2, "Proprietary")]


def test_texts_without_a_telling_word_are_not_cut(spark):
    sets = {(name, n): sorted(set(pairs(flat(t)))) for name, ts in licences.TEMPLATES.items() for n, t in enumerate(ts)}
    for threshold in (0.5, 0.8, 1.0):
        told = licences.telling(sets, threshold)
        assert threshold < 0.8 or all(len(w) > 2 for w in told)
        for b in sets.values():  # a passage of only shared bigrams that just reaches the threshold
            shared = next(m for m in range(1, len(b) + 1) if 2 * m / (m + len(b)) >= threshold)
            assert sum(any(w in pair for w in told) for pair in b) > len(b) - shared
    assert licences.telling({("x", 0): ["a"], ("x", 1): ["b c"]}, 0.8) == ["c", "a"]
    texts = ["RELEASED UNDER THE MIT LICENSE!", "Released-under*the\nMIT Licence", "all RIGHTS reserved", "Licenſed under CC BY 4.0", "right", None]
    got, _ = scanned(spark, texts)
    assert got == {k: expected(t or "") for k, t in enumerate(texts)} and got[0] and got[2]
    plan = licences.scan(spark.createDataFrame([(1, "a")], "doc_id long, text string"))._jdf.queryExecution().optimizedPlan().toString()
    cuts = [line for line in plan.split("\n") if "Filter" in line and "exists(array(lower(text" in line]
    assert len(cuts) == 2  # both readings of the texts begin with it
