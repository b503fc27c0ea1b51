"""Every operator on NULLs, empty and long texts, ties, repeated rows, empty tables and clashing names."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.conftest import bag
from tidewheel.llm import ans, decontam, hosts, jaccard, langid, licences, packing, pii, rules, shards
from tidewheel.llm.queries import TOKENIZER

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard int, _row long, verdict string, lang_pred string"
LONG = "lorem ipsum dolor sit amet " * 9000
PASSAGE = " ".join(f"word{k}" for k in range(40))
ROWS = [
    (1, None, "en", "a"), (2, "", "en", "a"), (3, "one two", "en", None), (4, "ONE\ttwo", None, "a"), (5, LONG, "fr", "a"),
    (6, PASSAGE, "en", "a"), (6, PASSAGE, "en", "a"), (7, PASSAGE + " tail", "en", "b"), (None, PASSAGE, "en", "b"),
    (8, "   \n \x0b ", "en", "a"), (9, "mail me at joe@example.com or +1 (437) 555-0689 now", "en", "a"), (10, "日本語 İ é", "ja", "a"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, g, s, 0, 7, 8, "x", "zz") for i, t, g, s in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def test_quality_rules(spark, docs, none):
    labels = spark.createDataFrame([(1, 1, 0), (6, 0, 0), (6, 1, 0), (None, 1, 1), (99, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    out = rules.judged(docs, labels)
    assert out.columns[: len(docs.columns)] == docs.columns and out.count() == len(ROWS)
    got = {r.doc_id: r for r in out.collect()}
    assert got[1][rules.MEASURES].n_words == 0 and not got[1]._kept and got[6]._kept
    assert not got[5]._kept and got[5][rules.MEASURES].n_repeat_words == 45000
    assert rules.kept(none, labels).count() == 0 and rules.kept(docs, labels.limit(0)).columns == docs.columns


def test_shards(docs, none):
    out = shards.shard_by_bytes(docs, 4).collect()
    assert len(out) == len(ROWS)
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert shards.shard_by_bytes(none, 4).count() == 0


def test_shards_split_copies(spark):
    copies = spark.range(400).select("id", F.lit("same text").alias("text"))
    counts = [r["count"] for r in shards.shard_by_bytes(copies, 8).groupBy("shard").count().collect()]
    assert len(counts) == 8 and max(counts) - min(counts) <= 1


def test_shards_move_rows_once(spark, docs):
    """The rows before each file are a small table whatever Spark's own threshold: texts are not shuffled for them."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out = shards.shard_by_bytes(docs, 4)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan and "BroadcastHashJoin" in plan
        assert out.count() == len(ROWS)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_packing_round_trip(docs, none):
    whole = Tokenizer.from_file(TOKENIZER)
    want = sorted(tuple(whole.encode(t or "", add_special_tokens=False).ids) + (0,) for _, t, *_ in ROWS)
    rows = packing.packed(docs, TOKENIZER, size=64).collect()
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append((r.start, np.frombuffer(bytes(r.ids), "<u4").tolist()))
    for b in bins.values():
        assert [o for o, _ in sorted(b)] == list(np.cumsum([0] + [n for _, n in sorted(b)])[:-1]) and sum(n for _, n in b) <= 64
    assert sorted(i for p in pieces.values() for _, ids in p for i in ids) == sorted(i for w in want for i in w)
    for doc in (5, 9, 10):
        text = next(t for i, t, *_ in ROWS if i == doc)
        assert [i for _, ids in sorted(pieces[doc]) for i in ids] == whole.encode(text, add_special_tokens=False).ids + [0]
    assert packing.packed(none, TOKENIZER).count() == 0


def test_coded_files(spark, docs, none, folder):
    whole = Tokenizer.from_file(TOKENIZER)
    ans.write_encoded(docs, f"{folder}/a", TOKENIZER, 2)
    rows = sorted(ans.read_encoded(spark, f"{folder}/a").collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted((i for i, *_ in ROWS), key=lambda i: -1 if i is None else i)
    at = 0
    for r in rows:
        texts = [t for i, t, *_ in ROWS if i == r.doc_id]
        assert r.start == at and np.frombuffer(bytes(r.ids), "<u4").tolist() == whole.encode(texts[0] or "", add_special_tokens=False).ids + [2]
        at += r.n_ids
    ans.write_encoded(none, f"{folder}/b", TOKENIZER, 2)
    assert ans.read_encoded(spark, f"{folder}/b").count() == 0


def test_jaccard(docs, none):
    got = defaultdict(set)
    for r in jaccard.classes(docs).collect():
        got[r.doc_id].add((r.n_shingles, r.component_id))
    assert got[6] == {(36, 6)} and got[7] == {(37, 6)} and got[None] == {(36, 6)}
    assert got[1] == {(0, 1)} and got[8] == {(0, 8)} and got[3] == {(1, 3)} == got[4] and got[5] == {(5, 5)}
    kept = jaccard.deduplicated(docs)
    assert kept.columns == docs.columns
    assert bag(kept, "doc_id") == [(1,), (2,), (3,), (5,), (6,), (8,), (9,), (10,)]
    assert jaccard.deduplicated(none).count() == 0


def test_language(docs, none):
    model = langid.fit(docs, sample=40)
    got = {r.doc_id: r for r in langid.predict(docs, model).collect()}
    assert got[1].lang_pred == "und" and got[8].score == 0.0 and got[5].lang_pred in model.languages and len(got[5]) == len(docs.columns) + 1
    empty = langid.fit(none)
    assert empty.languages == [] and {r.lang_pred for r in langid.predict(docs, empty).collect()} == {"und"}
    assert langid.predict(none, model).count() == 0


def test_decontamination(spark, docs, none):
    items = spark.createDataFrame([(1, PASSAGE), (2, "one two"), (3, None), (4, ""), (5, PASSAGE)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.leaks(docs, items).collect()}
    assert got == {(d, i) for d in (6, 7, None) for i in (1, 5)} | {(3, 2), (4, 2)}
    left = decontam.cleaned(docs, items)
    assert left.columns == docs.columns and bag(left, "doc_id") == [(1,), (2,), (5,), (8,), (9,), (10,)]
    assert decontam.leaks(none, items).count() == 0 and decontam.cleaned(docs, items.limit(0)).count() == len(ROWS)


def test_personal_data(docs, none):
    got = {r.doc_id: r for r in pii.found(docs).select("doc_id", pii.spelled(F.col("_spans")).alias("s")).collect()}
    assert got[9].s == "email:11:26,phone:30:47" and got[1].s == "" and len(got) == len({i for i, *_ in ROWS})
    out = pii.masked(docs)
    assert out.columns == docs.columns and out.count() == len(ROWS)
    row = out.where("doc_id = 9").first()
    assert row.text == "mail me at <EMAIL> or <PHONE> now" and row.n_chars == len(row.text)
    assert pii.masked(none).count() == 0


def test_hosts(spark):
    pages = spark.createDataFrame(
        [
            (1, "http://good.com/a", '<a href="http://fine.org/">', "x"), (2, "https://BAD.net/fr/x?y#z", None, "x"),
            (3, "http://fine.org", "", "x"), (4, None, "", "x"), (5, "no-scheme", "", "x"), (6, "http://pal.org/p", "<a href='//bad.net/q'>", "x"),
            (6, "http://pal.org/p", "<a href='//bad.net/q'>", "x"), (7, "http://", "", "x"),
        ],
        "page_id long, url string, html string, verdict string",
    )
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in hosts.judged(pages, [("allow", "com/"), ("block", "net/fr/")]).collect()}
    assert got[1] == ("good.com", "/a", "com/", "allow") and got[2] == ("bad.net", "/fr/x", "net/fr/", "block")
    assert got[3] == ("fine.org", "", None, "allow") and got[6] == ("pal.org", "/p", None, "block")
    assert got[4] == got[5] == got[7] == ("", "", None, "allow")
    assert hosts.judged(pages.limit(0), [("allow", "com/")]).count() == 0


def test_licences(spark, docs, none):
    assert licences.scan(docs).count() == 0 and licences.scan(none).count() == 0
    more = spark.createDataFrame(
        [(1, "some text before it\nReleased under the MIT License.\nand more after it"), (2, "released  under the mit licence."), (3, "All rights reserved."), (3, "All rights reserved.")],
        "doc_id long, text string",
    )
    assert bag(licences.scan(more), "doc_id", "part", "place", "licence") == [(1, "line", 1, "MIT"), (3, "line", 0, "Proprietary"), (3, "line", 0, "Proprietary")]


def test_pipeline_on_edges(spark, docs, none, folder):
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([(1, "never seen " * 5)], "item_id long, text string")
    for name, frame in (("some", docs), ("none", none)):
        frame.write.parquet(f"{folder}/{name}/documents.parquet")
        labels.write.parquet(f"{folder}/{name}/labels.parquet")
        items.write.parquet(f"{folder}/{name}/benchmark.parquet")
    assert corpus_pipeline.run(spark, f"{folder}/none").count() == 0
    rows = corpus_pipeline.run(spark, f"{folder}/some").collect()
    assert {r.doc_id for r in rows} == {6}
    assert zlib.crc32(bytes(rows[0].ids)) and rows[0].offset == 0


def test_stages_leave_columns_of_any_name_alone(spark, docs):
    """Columns named like an operator's own helpers come out with their values."""
    helpers = ["_row", "_place", "_w", "_cuts", "_stratum", "_kept", "_token", "_base", "_pii", "_spans", "_pii_row", "_built", "_masked", "_own", "a.b"]
    plain = docs.select("doc_id", "text", "lang", "n_chars")
    named = plain.select("*", *[F.concat(F.lit(f"{h}:"), F.coalesce("text", F.lit("")).substr(1, 9)).alias(h) for h in helpers])
    labels = spark.createDataFrame([(6, 1, 0)], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([(1, PASSAGE)], "item_id long, text string")
    stages = [lambda d: rules.kept(d, labels), jaccard.deduplicated, lambda d: decontam.cleaned(d, items), pii.masked]
    for stage in stages:
        out = stage(named)
        assert out.columns == named.columns and out.schema["_row"].dataType.simpleString() == "string"
        got = out.select(F.array(*[F.col(f"`{h}`") for h in helpers]).alias("v"), *plain.columns).collect()
        if stage is not pii.masked:
            assert all(list(r.v) == [f"{h}:{(r.text or '')[:9]}" for h in helpers] for r in got)
        else:
            assert all([v.split(":", 1)[0] for v in r.v] == helpers for r in got)
        assert bag(out.select(*plain.columns), *plain.columns) == bag(stage(plain), *plain.columns)


def test_stages_do_not_shuffle_texts_to_meet_a_few_rows(spark, docs):
    """What a stage found out about a small part of the rows comes to the texts, whatever Spark's own threshold."""
    items = spark.createDataFrame([(1, "Anna paid 20 dollars for the last nine tickets to Paris in June")], "item_id long, text string")
    texts = ["She wrote: Anna paid 30 dollars for the last nine tickets to Paris in June", *[f"call me under id {c}@example.com or id Z{k}Y-77" for k, c in enumerate("abcd")]]
    extra = spark.createDataFrame([(20 + k, t, "en", "a", 0, 7, 8, "x", "zz") for k, t in enumerate(texts)], SCHEMA)
    rows = docs.unionByName(extra)
    stages = [jaccard.deduplicated, lambda d: decontam.cleaned(d, items), pii.masked]
    want = [bag(stage(rows), "doc_id", "text") for stage in stages]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        for stage, result in zip(stages, want, strict=True):
            out = stage(rows)
            plan = out._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan and "BroadcastHashJoin" in plan
            assert bag(out, "doc_id", "text") == result
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_suspects_meet_their_texts_without_a_shuffle(spark, docs, monkeypatch):
    """The texts that are cut for their slots are found by their row numbers."""
    items = spark.createDataFrame([(1, "Anna paid 20 dollars for the last nine tickets to Paris in June")], "item_id long, text string")
    met = []
    joined = type(docs).join
    monkeypatch.setattr(type(docs), "join", lambda left, right, *a: met.append((left, joined(left, right, *a))) or met[-1][1])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        decontam.cleaned(docs, items)
        plans = [out._jdf.queryExecution().executedPlan().toString() for left, out in met if "text" in left.columns]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(plans) == 2 and all("BroadcastHashJoin" in p and "SortMergeJoin" not in p for p in plans)


def test_representatives_are_found_either_way(spark, monkeypatch):
    """More copies than representatives, fewer, and both too large to broadcast."""
    for copies, small in ((1, True), (9, True), (9, False)):
        if not small:
            monkeypatch.setattr(jaccard, "broadcast_hint", lambda df: lambda frame: frame)
        rows = [(100 * k + c, " ".join(f"w{k}x{i}" for i in range(30))) for k in range(4) for c in range(copies)]
        out = jaccard.deduplicated(spark.createDataFrame([*rows, (999, None)], "doc_id long, text string"))
        assert bag(out, "doc_id") == [(0,), (100,), (200,), (300,), (999,)]
