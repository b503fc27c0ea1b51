"""MinHash groups against all pairs, and components against a plain search."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from tests.conftest import bag
from tidewheel.operators.graphs import components
from tidewheel.operators.similar import drop_similar, similar_groups


def closed(nodes, pairs):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute_groups(rows):
    sets = {}
    for i, t in rows:
        words = re.findall(r"[a-z0-9]+", (t or "").lower())
        sets[i] = {" ".join(words[k : k + 5]) for k in range(len(words) - 4)} or ({" ".join(words)} if words else set())
    ids = sorted(sets)
    pairs = [
        (a, b) for k, a in enumerate(ids) for b in ids[k + 1 :]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    return closed(ids, pairs)


def edited(rnd, words, n):
    words = list(words)
    for _ in range(n):
        words[rnd.randrange(len(words))] = f"x{rnd.randrange(10**6)}"
    return " ".join(words)


def test_groups_equal_those_of_all_pairs(spark):
    rnd = random.Random(5)
    rows, base = [], [[f"w{rnd.randrange(900)}" for _ in range(rnd.randrange(60, 160))] for _ in range(12)]
    for i in range(240):
        rows.append((i, edited(rnd, rnd.choice(base), rnd.randrange(5))))
    rows += [(300, None), (301, ""), (302, "?!"), (303, "two words"), (304, "Two, words!"), (305, rows[7][1].upper() + " .")]
    df = spark.createDataFrame([(i, t, "k") for i, t in rows], "doc_id long, text string, _id string")
    got, want = dict(bag(similar_groups(df, "text", "doc_id"))), brute_groups(rows)
    assert got.keys() == want.keys()
    same = [(a, b) for a in want for b in want if a < b and want[a] == want[b]]
    found = [p for p in same if got[p[0]] == got[p[1]]]
    assert len(found) >= 0.9 * len(same)
    # nothing is put together that is not linked
    assert all(want[i] == want[g] for i, g in got.items())
    assert drop_similar(df, "text", "doc_id").columns == df.columns


def test_bucket_with_a_third_of_all_rows(spark):
    """400 of 1200 texts are near copies of one: pairs compared stay near texts times rounds."""
    rnd = random.Random(6)
    hot = [f"h{k}" for k in range(200)]
    rows = [(i, edited(rnd, hot, 2) if i % 3 == 0 else edited(rnd, [f"d{i}"] * 50, 49)) for i in range(1200)]
    got = dict(bag(similar_groups(spark.createDataFrame(rows, "doc_id long, text string"), "text", "doc_id")))
    assert all(got[i] == 0 for i in range(0, 1200, 3)) and all(got[i] == i for i in range(1200) if i % 3)


def test_components(spark):
    rnd = random.Random(7)
    pairs = [(i, i + 1) for i in range(40)] + [(1000, k) for k in range(1001, 1100)] + [(k, k) for k in (5, 2000)]
    pairs += [(rnd.randrange(3000, 3100), rnd.randrange(3000, 3100)) for _ in range(60)]
    rnd.shuffle(pairs)
    nodes = {n for a, b in pairs if a != b for n in (a, b)}
    got = dict(bag(components(spark.createDataFrame(pairs, "a long, b long"))))
    assert got == {n: r for n, r in closed({n for p in pairs for n in p}, pairs).items() if n in nodes}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert similar_groups(none, "text", "doc_id").count() == 0
    assert similar_groups(spark.range(3).select(F.col("id").alias("doc_id"), F.lit(None).cast("string").alias("text")), "text", "doc_id").where("doc_id = group_id").count() == 3
