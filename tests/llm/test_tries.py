"""The prefix trie against plain dictionaries."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict
from zlib import crc32

import pytest

from tests.conftest import bag
from tidewheel.llm import tries

SCHEMA = "conv_id long, turn int, role string, text string, _c int, depth string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def ordered(rows):
    convs = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            convs[c].append(((turn is not None, turn or 0), sha(f"{len(role.encode())}:{role}{text}"), role, text))
    return {c: [x[2:] for x in sorted(v)] for c, v in convs.items()}


def rebuilt(convs):
    out = {}
    for c, turns in convs.items():
        h = crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        out[c] = convs.get(base, [])[:h] + turns[h:]
    return out


def brute(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    for p, who in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in kids
            saved[p[:d]] += (len(who) - 1) * len(p[-1][1].encode()) if p else 0
    rows = []
    for p, who in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in who if len(convs[c]) == len(p)))
        rows.append((min(who), len(p), min(members[p[:-1]]) if p else None, len(who), kids[p], leaves[p], saved[p], sha(ends)))
    return sorted(rows, key=lambda r: tuple((v is not None, v) for v in r))


def sample(seed, n, longest, words):
    rnd = random.Random(seed)
    stems = [[("user" if k % 2 else "bot", rnd.choice(words)) for k in range(longest)] for _ in range(4)]
    rows = []
    for c in range(-7, n):
        stem = rnd.choice(stems)
        cut = rnd.randrange(longest + 1)
        turns = stem[:cut] + [("x", rnd.choice(words)) for _ in range(rnd.randrange(3))]
        rows += [(c, k, role, text) for k, (role, text) in enumerate(turns)]
    return rows


def check(spark, rows, rebuild=True):
    turns = spark.createDataFrame([(*r, 5, "deep") for r in rows], SCHEMA)
    numbered = tries.numbered_turns(turns)
    if rebuild:
        got, want = tries.prefix_trie(*tries.with_shared_openings(numbered)), brute(rebuilt(ordered(rows)))
    else:
        got, want = tries.prefix_trie(numbered, numbered.select("_c").distinct()), brute(ordered(rows))
    assert bag(got) == want
    return want


def test_rebuilt_conversations(spark):
    rows = sample(1, 60, 22, ["", "a", "b", "längeres Wort"])
    rows += [(None, 0, "user", "nobody"), (70, None, None, None), (70, 0, "user", "hi"), (70, 0, "user", "hi"), (70, None, "bot", "x"),
             (71, 3, "a", "b"), (71, 3, "ab", ""), (71, 3, "", "ab"), (72, 0, None, "t")]
    assert any(r[3] > 5 for r in check(spark, rows))


@pytest.mark.parametrize("block, span", [(1, 2), (3, 2), (8, 64)])
def test_long_conversations_over_several_spans(spark, monkeypatch, block, span):
    monkeypatch.setattr(tries, "BLOCK", block)
    monkeypatch.setattr(tries, "SPAN", span)
    check(spark, sample(2, 12, 21, ["a", "b"]), rebuild=False)


def test_snapshots_of_a_growing_conversation_and_copies(spark, monkeypatch):
    monkeypatch.setattr(tries, "PIECE", 4)
    rows = [(c, k, "u", f"turn {k}") for c in range(20) for k in range(c + 1)]
    rows += [(c, k, "u", f"turn {k}") for c in range(100, 130) for k in range(3)]
    want = check(spark, rows, rebuild=False)
    assert max(r[1] for r in want) == 20 and any(r[3] == 50 for r in want)


def test_empty_and_turnless(spark):
    none = spark.createDataFrame([], SCHEMA)
    numbered = tries.numbered_turns(none)
    assert tries.prefix_trie(*tries.with_shared_openings(numbered)).count() == 0
    # conversations of few turns whose opening is absent: nothing but the root
    lone = [c for c in range(1, 200) if c % 5 and crc32(str(c).encode()) % 9 >= 2][:3]
    check(spark, [(c, 0, "u", "only") for c in lone])
