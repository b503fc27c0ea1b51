"""Block naming against plain grouping by text."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.conftest import bag
from tidewheel.llm import naming

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, keep_id string, _n long, _d long, kept int"


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(LOWER)].append(i)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        stays = [False] * len(ids)
        stays[ids.index(keep)] = True
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, keep, len(ids), k, sha) for i, k in zip(ids, stays, strict=True)]
    return sorted(out, key=lambda r: tuple((v is not None, v) for v in r))


def sample():
    rnd = random.Random(3)
    texts = [None, "", " ", "Ä", "ä", "İ", "a\x00b", "A\x00b"]
    for n in (1, 7, 8, 9, 15, 16, 17, 31, 64, 65):
        base = "".join(rnd.choice("abAB ") for _ in range(n))
        texts += [base, base.upper(), base[:-1] + "c", "c" + base[1:], base + "a", base * 2]
    texts += ["ab" * 2000, "AB" * 2000, "ab" * 2000 + "a", "日本" * 300, "日本" * 300]
    rows = [(k, t) for k, t in enumerate(texts * 2)]
    return rows + [(3, rows[3][1]), (None, "alone"), (None, "Alone"), (None, rows[9][1]), (None, None)]


@pytest.mark.parametrize("digest", ["xxhash64", "length", "few"])
def test_against_grouping(spark, digest):
    """Also with digests that most blocks share, so that bytes must decide."""
    rows = sample()
    docs = spark.createDataFrame([(i, t, "x", 1, 2, 3) for i, t in rows], SCHEMA)
    how = {"xxhash64": F.xxhash64, "length": lambda b: F.octet_length(b).cast("long"), "few": lambda b: F.xxhash64(b) % 3}[digest]
    found = naming.named(docs, block=8, digest=how)
    assert bag(found, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == brute(rows)
    kept = naming.deduplicated(docs, block=8, digest=how)
    assert kept.columns == docs.columns
    assert sorted((t or "").translate(LOWER) for (t,) in kept.select("text").collect()) == sorted({(t or "").translate(LOWER) for _, t in rows})
    assert {tuple(r) for r in kept.select("keep_id", "_n", "_d", "kept").distinct().collect()} == {("x", 1, 2, 3)}


def test_more_shared_digests_than_are_listed(spark, monkeypatch):
    monkeypatch.setattr(naming, "LISTED", 2)
    rows = sample()
    found = naming.named(spark.createDataFrame(rows, "doc_id long, text string"), block=4, digest=lambda b: F.crc32(b) % 7)
    assert bag(found, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == brute(rows)


def test_a_third_of_all_rows_equal(spark):
    docs = spark.range(900).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("hot text " * 40)).otherwise(F.col("id").cast("string")).alias("text"))
    found = naming.named(docs, block=16)
    assert found.where("group_size = 300 AND keep_id = 897").count() == 300 and found.where("kept").count() == 601


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert naming.named(none).count() == 0 and naming.deduplicated(none).columns == ["doc_id", "text"]
    blank = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert bag(naming.named(blank), "doc_id", "keep_id", "kept") == [(1, 2, False), (2, 2, True)]
