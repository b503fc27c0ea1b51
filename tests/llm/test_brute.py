"""Operators against brute force, round trips and held-out accuracy."""

from __future__ import annotations

import itertools
import math
import random
import re
import tracemalloc
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewheel.llm import ans, decontam, jaccard, packing, pii, rules, workers
from tidewheel.llm.queries import QUERIES, TOKENIZER
from tidewheel.llm.shingles import shingle_sets
from tidewheel.llm.tokens import WordEncoder

BASE = "/root/testdata/sf0.001"
SPACE = re.compile("[\x20\x09-\x0d]+")


def shingles(text: str | None) -> set:
    words = [w for w in SPACE.split(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def classes_of(texts: dict) -> dict:
    sets = {k: shingles(t) for k, t in texts.items()}
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            lo, hi = sorted((find(a), find(b)))
            root[hi] = lo
    return {k: (len(sets[k]), find(k)) for k in sets}


def varied(seed: int) -> dict[int, str]:
    """Groups of near copies in chains and stars, shared passages, copies, and texts on the boundary."""
    rng = random.Random(seed)
    word = lambda: "w" + str(rng.randrange(3000))
    out: list[str] = []
    shared = [word() for _ in range(60)]
    for _ in range(6):
        base = [word() for _ in range(rng.choice([4, 5, 8, 30, 120]))]
        current = list(base)
        for k in range(rng.choice([2, 5, 25])):
            if k % 3 == 0:
                current = list(base)
            for _ in range(max(1, len(current) // rng.choice([25, 40, 60]))):
                current[rng.randrange(len(current))] = word()
            out.append(" ".join(current))
    out += [" ".join([word() for _ in range(5)] + shared + [word() for _ in range(rng.randrange(40))]) for _ in range(60)]
    out += ["a b c d e f g", "a b c d e f g h", "a b c d e f g h i", "A B  c\td", "", "x"] * 2
    rng.shuffle(out)
    return dict(enumerate(out))


@pytest.mark.parametrize("seed, part", [(1, jaccard.PART), (2, jaccard.PART), (3, 400)])
def test_jaccard_classes(spark, monkeypatch, seed, part):
    monkeypatch.setattr(jaccard, "PART", part)
    texts = varied(seed)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.classes(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert got == classes_of(texts)


def test_jaccard_large_group_takes_few_comparisons(spark, monkeypatch):
    """A star of 300 near copies: fewer comparisons than a tenth of all pairs, and no link lost."""
    rng = random.Random(3)
    base = [f"w{k}" for k in range(100)]
    texts = {0: " ".join(base)}
    for k in range(1, 300):
        copy = list(base)
        copy[rng.randrange(100)] = f"new{k}"
        copy[rng.randrange(100)] = f"more{k}"
        texts[k] = " ".join(copy)
    seen = []
    plain = jaccard._compared
    monkeypatch.setattr(jaccard, "_compared", lambda pairs, sets: (seen.append(pairs.count()), plain(pairs, sets))[1])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.classes(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert got == classes_of(texts)
    assert sum(seen) < 300 * 299 / 2 / 10


def linked_by(spark, monkeypatch, texts):
    """Classes, and the number of comparisons."""
    seen = []
    plain = jaccard._compared
    monkeypatch.setattr(jaccard, "_compared", lambda pairs, sets: (seen.append(pairs.count()), plain(pairs, sets))[1])
    found = jaccard.classes(spark.createDataFrame(list(texts.items()), "doc_id long, text string"))
    return {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()}, sum(seen)


def test_jaccard_similar_texts_that_do_not_link(spark, monkeypatch):
    """Each text has four words of its own: all share most shingles, next to none link."""
    rng = random.Random(8)
    base = [f"w{k}" for k in range(100)]
    texts = {}
    for k in range(400):
        copy = list(base)
        for at in rng.sample(range(100), 4):
            copy[at] = f"own{k}x{at}"
        texts[k] = " ".join(copy)
    got, compared = linked_by(spark, monkeypatch, texts)
    assert got == classes_of(texts) and compared <= 20 * len(texts)


def test_jaccard_chain(spark, monkeypatch):
    """Every text links with its neighbours only, and all are one class."""
    texts = {k: " ".join(f"w{3 * k + i}" for i in range(60)) for k in range(200)}
    got, compared = linked_by(spark, monkeypatch, texts)
    assert got == classes_of(texts) and {c for _, c in got.values()} == {0} and compared <= 20 * len(texts)


def test_shingle_sets_match_python():
    texts = ["", None, "a", "a b c d e", "A b  C\nd e f", " x ", "é ü b c d e", "a b c d e f a b c d e f", "\x1c a\x1cb"]
    sizes, names = [], []
    for _, _, n, name in shingle_sets(pa.array(texts, pa.string())):
        sizes += n.tolist()
        names += name.tolist()
    sets = [shingles(t) for t in texts]
    assert sizes == [len(s) for s in sets]
    for i, j in itertools.combinations(range(len(texts)), 2):
        assert (names[i] == names[j]) == (sets[i] == sets[j])


def test_binomial_tail(spark):
    rows = [(n, k) for n in (1, 5, 40, 1000, 50000) for k in (0, 1, 3, 11, 300, 480) if k <= n]
    frame = spark.createDataFrame(rows, "n long, k long").select("n", "k", rules.binomial_tail(F.col("n"), F.col("k"), 0.01).alias("p"))
    for r in frame.collect():
        terms = [math.lgamma(r.n + 1) - math.lgamma(i + 1) - math.lgamma(r.n - i + 1) + i * math.log(0.01) + (r.n - i) * math.log(0.99) for i in range(r.k + 1)]
        want = math.fsum(math.exp(t) for t in terms) if r.k < r.n * 0.01 else 1.0
        assert r.p == pytest.approx(want, rel=1e-8)


def test_cutoffs_keep_their_promise(spark):
    """Labels with 1 % of good documents above each cutoff: the cutoff that rejects more than its share stays unused."""
    rng = random.Random(4)
    shares = [(i, "en", 1, 5.0 if i % 50 == 0 else 0.0) for i in range(3000)] + [(9000 + i, "en", 0, rng.choice([5.0, 35.0])) for i in range(500)]
    frame = spark.createDataFrame(shares, "doc_id long, lang string, quality int, symbols double")
    zero = F.lit(0.0)
    scored = frame.select(
        "doc_id", "lang",
        F.struct(F.lit(False).alias("base_failed"), F.struct(F.col("symbols"), *[zero.alias(r) for r in rules.CUTOFFS if r != "symbols"]).alias("shares")).alias(rules.MEASURES),
    )
    found = rules.fit_cutoffs(scored, frame.select("doc_id", "quality")).collect()
    assert [(r.rule, r.n_good, r.n_false) for r in found] == [("symbols", 3000, 0)] and 5 <= found[0].cutoff < 35


def test_rules_measures(spark):
    docs = spark.read.parquet(f"{BASE}/documents.parquet")
    got = {r.doc_id: r[rules.MEASURES] for r in rules.measured(docs).collect()}
    for r in docs.collect():
        words = [w for w in SPACE.split(r.text or "") if w]
        places = defaultdict(list)
        for i in range(len(words) - 7):
            places[tuple(words[i : i + 8])].append(i)
        covered = {p + j for v in places.values() if len(v) > 1 for p in v for j in range(8)}
        lines = [x for x in (r.text or "").split("\n") if SPACE.sub("", x)]
        m = got[r.doc_id]
        assert (m.n_words, m.word_chars, m.n_dup_lines, m.n_repeat_words) == (len(words), sum(map(len, words)), len(lines) - len(set(lines)), len(covered))
        assert m.n_symbols == sum((r.text or "").count(c) for c in "#*$%&|<>")
        assert m.base_failed == (len(words) < 20 or 100 * len(covered) > 30 * len(words))


def test_coder_round_trip_checkpoints_and_damage():
    rng = np.random.default_rng(1)
    for n in (0, 1, 63, 64, 5000, 300_000):
        ids = np.minimum(rng.zipf(1.3, n), 5000).astype(np.uint32)
        coder = ans.Coder(ans.frequencies(np.bincount(ids, minlength=5001)))
        coded = coder.encode(ids)
        assert np.array_equal(coder.decode(coded), ids)
        if n == 300_000:
            parts = [coder.decode(coded, 0, 1), coder.decode(coded, 1, 2), coder.decode(coded, 2)]
            assert np.array_equal(np.concatenate(parts), ids)
            assert len(coded) < 2 * n
            broken = bytearray(coded)
            broken[len(coded) // 2] ^= 1
            try:
                assert not np.array_equal(coder.decode(bytes(broken)), ids)
            except ans.Corrupt:
                pass
    assert ans.frequencies(np.array([0, 1, 10**12, 1])).sum() == 1 << ans.SCALE


def test_damaged_files_stop_the_read(spark, folder):
    from tidewheel.llm.queries import TOKENIZER

    ans.write_encoded(spark.createDataFrame([(1, "some words here")], "doc_id long, text string"), folder + "/x", TOKENIZER, 2)
    blocks = spark.read.parquet(folder + "/x/blocks").withColumn("ids_crc", F.col("ids_crc") + 1)
    blocks.write.parquet(folder + "/y/blocks")
    spark.read.parquet(folder + "/x/model").write.parquet(folder + "/y/model")
    with pytest.raises(Exception, match="checksum"):
        ans.read_encoded(spark, folder + "/y").collect()


def fewest(lengths: list[int], size: int) -> int:
    best = len(lengths)

    def go(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for k in range(len(rooms)):
            if rooms[k] >= lengths[i] and rooms[k] not in rooms[:k]:
                go(i + 1, rooms[:k] + [rooms[k] - lengths[i]] + rooms[k + 1 :])
        go(i + 1, [*rooms, size - lengths[i]])

    go(0, [])
    return best


def test_bin_completion_finds_the_fewest():
    rng = random.Random(2)
    better = 0
    for _ in range(150):
        lengths = [rng.randint(15, 60) for _ in range(rng.randint(1, 10))]
        bins = packing.bin_completion(lengths, 100)
        assert sorted(i for b in bins for i in b) == list(range(len(lengths))) and all(sum(lengths[i] for i in b) <= 100 for b in bins)
        assert len(bins) == fewest(sorted(lengths, reverse=True), 100)
        better += len(bins) < len(packing.best_fit(lengths, 100))
    assert packing.bin_completion([], 100) == []
    hard = [44, 42, 41, 33, 32, 27, 26, 25, 30]  # three exact fillings that best fit misses
    assert len(packing.bin_completion(hard, 100)) == 3


def test_fillings_are_all_that_no_other_betters():
    got = {tuple(x for x, n in f for _ in range(n)) for _, f in packing.Pieces([50, 45, 25, 25]).fillings(100, 100)}
    assert got == {(50, 45), (50, 25, 25)}
    rng = random.Random(5)
    for _ in range(200):
        lengths = [rng.randint(1, 40) for _ in range(rng.randint(1, 9))]
        room = rng.randint(1, 80)
        fits = lambda c: sum(c) <= room
        sets = {tuple(sorted(c, reverse=True)) for k in range(len(lengths) + 1) for c in itertools.combinations(lengths, k) if fits(c)}
        got = {tuple(x for x, n in f for _ in range(n)) for _, f in packing.Pieces(lengths).fillings(room, room)}
        assert got <= sets
        for c in sets - got:  # each set left out is bettered by one that is listed, piece for one or more pieces
            assert any(betters(g, c) for g in got), (lengths, room, c)


def betters(big: tuple, small: tuple) -> bool:
    """Whether the pieces of ``small`` fit into bins as long as those of ``big``."""

    def go(i, rooms):
        return i == len(small) or any(r >= small[i] and go(i + 1, rooms[:k] + [r - small[i]] + rooms[k + 1 :]) for k, r in enumerate(rooms))

    return go(0, list(big))


def test_bin_completion_searches_large_groups():
    """3000 pieces cut from full sequences: fewer than best fit."""
    rng = random.Random(8)
    lengths = []
    for _ in range(1000):
        a = rng.randint(700, 1000)
        b = rng.randint(500, 690)
        lengths += [a, b, 2048 - a - b]
    bins = packing.bin_completion(lengths, 2048)
    assert sorted(i for b in bins for i in b) == list(range(3000)) and all(sum(lengths[i] for i in b) <= 2048 for b in bins)
    assert len(bins) < len(packing.best_fit(lengths, 2048))


def test_patterns_match_their_plain_forms(spark):
    rng = random.Random(6)
    plain = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    pieces = ["1", "12", ".", "-", " ", "+", "@", "a.b", "x", "(", ")", "4111111111111111", "255", "_", "\n", "é", "😀", "300.", "1.2.3.4"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(40))) for _ in range(1500)]

    def good(kind, m):
        digits = re.sub("[^0-9]", "", m)
        if kind == "ip":
            return all(int(p) <= 255 for p in m.split("."))
        if kind == "card":
            s = sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(int(c) for c in reversed(digits)))
            return 12 <= len(digits) <= 19 and s % 10 == 0
        return kind == "email" or 9 <= len(digits) <= 15

    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.spotted(frame).select("doc_id", "_pii.base").collect():
        want = [(m.start(), o, m.end()) for o, k in enumerate(pii.KINDS) for m in re.finditer(plain[k], texts[r.doc_id]) if good(k, m[0])]
        assert sorted((b.start, b.order, b.stop) for b in r.base) == sorted(want), texts[r.doc_id]


def test_contexts_discover_unseen_identifiers(spark):
    seeds = [(i, f"please write badge 4{i:014d} now") for i in range(200)]
    rows = [(i, t) for i, t in seeds] + [(1000, "please write badge 9123456789012345 now"), (1001, "the year 2024 and 1234567 things")]
    found = {r.doc_id: r.s for r in pii.found(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", pii.spelled(F.col("_spans")).alias("s")).collect()}
    base = {r.doc_id for r in pii.spotted(spark.createDataFrame(rows, "doc_id long, text string")).where("size(_pii.base) > 0").collect()}
    assert len(base) >= 10 and 1000 not in base and not found[1001]
    assert sum("context" in s for s in found.values()) in (0, 201 - len(base))  # all or none of the badges outside the base


def test_contexts_discover_identifiers_of_other_shapes(spark):
    """Phones and addresses lead to other shapes after the same words, and these to the words they stand after elsewhere."""
    new = ["078-05-1120", "219-09-9999", "X1234567", "Y2345678", "AB-123456", "CD-345678"]
    texts = {i: f"you can reach +1 (437) 555-{1000 + i} today" for i in range(100)}
    texts |= {150 + i: f"you can reach {x} soon" for i, x in enumerate(new)}  # one hop
    texts |= {200 + i: f"our passport {x}, and" for i, x in enumerate(new)} | {300: "his passport K7654321 or", 301: "old passport: L7654322."}  # two hops
    keys = ["3f786850e387550fdab836ed7e6dc881de23001b", "89e6c98d92887913cadf06b2adb97f26cde4849b"]
    texts |= {400 + i: f"token = user{i}@example.com" for i in range(5)} | {500: f"token = {keys[0]}", 501: f"token={keys[1]}"}
    texts |= {600: "you can reach 2024-05-06 again", 601: "price 1234567 paid", 602: "it had 78-05-11201 in it"}
    want = {}
    for i, x in [*((150 + i, x) for i, x in enumerate(new)), *((200 + i, x) for i, x in enumerate(new)), (300, "K7654321"), (301, "L7654322"), (500, keys[0]), (501, keys[1])]:
        want[i] = f"context:{texts[i].index(x)}:{texts[i].index(x) + len(x)}"
    out = pii.found(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).select("doc_id", pii.spelled(F.col("_spans")).alias("s"))
    got = {r.doc_id: r.s for r in out.collect()}
    assert {k: v for k, v in got.items() if v and not v.startswith(("phone", "email"))} == want
    assert sum(v.startswith(("phone", "email")) for v in got.values()) == 105


def test_reworded_questions_are_caught(spark):
    item = "A train leaves Boston at 40 miles per hour and meets Anna after 3 hours while Anna walks 40 miles on foot"
    new = "In short: A train leaves Denver at 55 miles per hour and meets Carl after 9 hours while Carl walks 55 miles on foot. Done."
    odd = "In short: A train leaves Denver at 55 miles per hour and meets Carl after 9 hours while Dora walks 71 miles on foot. Done."
    docs = spark.createDataFrame([(1, "x " + item), (2, new), (3, odd), (4, "nothing of the kind " * 9)], "doc_id long, text string")
    got = {r.doc_id: r.reworded for r in decontam.leaks(docs, spark.createDataFrame([(7, item)], "item_id long, text string")).collect()}
    assert got == {1: False, 2: True}


def test_copies_with_edited_values_are_caught(spark):
    item = "the farmer brings 3 apples to the old market and also sells 5 pears to a friend who waits there"
    long = " ".join(f"word{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(90))
    items = [(1, item), (2, f"in 1990 they met {long} and again in 1990 they left")]
    texts = [
        "x y z " + item.replace("3", "4").replace("5", "4"), "x y z " + item.replace("3", "5"),
        items[1][1].replace("again in 1990", "again in 1991"), items[1][1],
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r.reworded for r in decontam.leaks(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == {(0, 1): True, (1, 1): True, (2, 2): True, (3, 2): False}


def test_short_items_are_caught_after_any_text(spark):
    items = [(6, "What is the capital of France?"), (12, "Name every river that flows into the great northern sea today here."), (1, "Hello")]
    before = ["", "Question: ", "Q: ", "so, ", "as text "]
    texts = {10 * k + i: b + t for i, b in enumerate(before) for k, t in items if k > 1}
    texts |= {900: "well, Which is the capital of France?", 901: "so, Peter and Paul met"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.leaks(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == {(10 * k + i, k) for i in range(5) for k, _ in items if k > 1}


def test_held_out_language_accuracy(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{BASE}/documents.parquet").collect()}
    held = [r for r in QUERIES["op6_language_id"](spark, BASE).collect() if r.held_out and r.lang_pred != "und"]
    assert held and sum(truth[r.doc_id] == r.lang_pred for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in held)


def test_shards_are_near_equal(spark):
    rows = QUERIES["op3_byte_shards"](spark, BASE).collect()
    sizes, slots = Counter(), defaultdict(list)
    for r in rows:
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
    largest = max(r.size for r in rows)
    mean = sum(sizes.values()) / 40
    assert all(abs(sizes[k] - mean) <= largest + 1 for k in range(40))
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_licence_lines_are_found(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{BASE}/documents.parquet").collect()}
    found = {r.doc_id for r in QUERIES["op1_licence_scan"](spark, BASE).collect()}
    assert {k for k, t in docs.items() if re.search(r"(?m)^(Licensed under|Released under|This work is licensed)", t or "")} <= found


def test_host_rules(spark):
    for r in QUERIES["op10_host_graph"](spark, BASE).collect():
        fits = [(rule, v) for v, rule in (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")) if ("." + r.host).endswith("." + rule.split("/")[0]) and r.path.startswith("/" + rule.split("/", 1)[1])]
        if fits:
            assert (r.rule, r.verdict) == max(fits, key=lambda f: len(f[0]))
        else:
            assert r.rule is None and r.verdict in ("allow", "block")


@pytest.mark.parametrize("seed", range(4))
def test_bin_completion_in_the_emptiest_sequences(seed):
    """Thousands of pieces that best fit puts in more sequences than the bound: all placed once, none overfull, never more."""
    rng = random.Random(seed)
    lengths = []
    for _ in range(700):
        cuts = sorted(rng.sample(range(1, 2048), rng.choice([1, 2, 3])))
        lengths += [b - a for a, b in zip([0, *cuts], [*cuts, 2048 - rng.randrange(2)], strict=True) if b > a]
    rng.shuffle(lengths)
    done = packing.bin_completion(lengths, 2048)
    assert sorted(i for b in done for i in b) == list(range(len(lengths)))
    assert all(sum(lengths[i] for i in b) <= 2048 for b in done)
    assert packing.least_bins(lengths, 2048) <= len(done) <= len(packing.best_fit(lengths, 2048))


def test_search_of_a_group_that_cannot_improve_ends():
    """No filling leaves little enough room: the steps of one search are bounded, also while it looks for a first filling."""
    rng = random.Random(5)
    lengths = [2 * rng.randrange(300, 700) for _ in range(3000)]
    steps = packing.Pieces(lengths)
    steps.most = 5000
    assert list(steps.fillings(2047, 0)) == [] and steps.steps <= 5000 + 8
    done = packing.bin_completion(lengths, 2047)
    assert sorted(i for b in done for i in b) == list(range(3000)) and len(done) <= len(packing.best_fit(lengths, 2047))


def test_jaccard_members_are_dealt_in_little_memory(spark, monkeypatch):
    caught = []
    docs = type("Docs", (), {"select": lambda self, *_: self, "mapInArrow": lambda self, run, _: caught.append(run)})()
    monkeypatch.setattr(jaccard, "HELD", 1_000_000)
    jaccard._members(docs, 7)
    rng = random.Random(4)
    texts = [" ".join(f"{rng.randrange(1 << 20):x}" for _ in range(2000)) for _ in range(600)]
    batches = [pa.RecordBatch.from_arrays([pa.array(texts[at : at + 100])], names=["text"]) for at in range(0, 600, 100)]
    tracemalloc.start()
    rows = [r for out in caught[0](batches) for r in out.to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 65e6  # one set of keys held and one copy to sort, and what a slice of texts takes
    got = set()
    for row in rows:
        names, sizes, index, steps, part = jaccard._unpacked(row["body"])
        assert part[0] == row["part"] and (sizes == 1996).all()
        members = np.cumsum(steps) * np.uint64(7) + part[0]
        got |= set(zip(names[index.astype(int)].tolist(), members.tolist(), strict=True))
    want = set()
    for _, members, sizes, names in shingle_sets(pa.array(texts)):
        want |= set(zip(np.repeat(names, sizes).tolist(), members.tolist(), strict=True))
    assert got == want and len(rows) == 14


def test_jaccard_members_are_matched_in_little_memory(spark, monkeypatch):
    caught = []
    docs = type("Docs", (), {"select": lambda self, *_: self, "mapInArrow": lambda self, run, _: caught.append(run)})()
    monkeypatch.setattr(jaccard, "_by_part", lambda blobs, parts, work: (docs, work))
    monkeypatch.setattr(jaccard, "RANGE", 100_000, raising=False)
    jaccard._members(docs, 1)
    jaccard._support(docs, 1, 75)
    rng = random.Random(4)
    texts = [" ".join(f"{rng.randrange(1 << 20):x}" for _ in range(2000)) for _ in range(600)]
    texts[7::100] = [texts[0][: 1000 + k] for k in range(6)]
    batches = [pa.RecordBatch.from_arrays([pa.array(texts[at : at + 100])], names=["text"]) for at in range(0, 600, 100)]
    bodies = [body for batch in batches for out in caught[0](iter([batch])) for body in out.column(1).to_pylist()]
    tracemalloc.start()
    rows = [r for out in caught[1](bodies) for r in out.to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 24e6  # ten bytes for each of 1.2 million members, and what one set of texts and one range takes
    holders = defaultdict(dict)
    for _, members, sizes, names in shingle_sets(pa.array(texts)):
        for m, name, n in zip(members.tolist(), np.repeat(names, sizes).tolist(), np.repeat(sizes, sizes).tolist(), strict=True):
            holders[m][name] = n
    fit = lambda a, b: 100 * min(a, b) >= 75 * max(a, b)
    want = {(x, m, n, len(h)) for m, h in holders.items() for x, n in h.items() if any(y != x and fit(n, k) for y, k in h.items())}
    got, groups = set(), defaultdict(set)
    for row in rows:
        names, sizes, runs, members, times, group = jaccard._unpacked(row["body"])
        runs = runs.astype(int)
        got |= set(zip(*(c.tolist() for c in (np.repeat(names, runs), members, np.repeat(sizes, runs), times)), strict=True))
        for g, m in zip(group.tolist(), members.tolist(), strict=True):
            groups[g].add(m)
    assert got == want and want
    for members in groups.values():  # the same holders, the same region
        assert len({frozenset(x for x, m, _, _ in want if m == one) for one in list(members)[:3]}) == 1


def test_workers_return_what_a_task_freed():
    """Small blocks freed below one in use stay with the C library until it is told."""
    def used() -> int:
        return int(Path("/proc/self/statm").read_text().split()[1]) * 4096

    kept = []

    def run(batches):
        blocks = [bytearray(100_000) for _ in range(1500)]
        kept.append(blocks.pop())
        before = used()
        del blocks
        kept.append(before)
        yield from batches

    assert list(workers.handing_back(run)(iter([1, 2]))) == [1, 2]
    assert used() < kept[1] - 100e6
    with pytest.raises(ZeroDivisionError):
        list(workers.handing_back(lambda batches: (1 // b for b in batches))([0]))


def test_tasks_of_the_pipeline_return_what_they_freed(spark, monkeypatch):
    caught, calls = [], []

    class Docs:
        columns = ["doc_id", "text"]

        def __getattr__(self, _):
            return lambda *_: self

        def mapInArrow(self, run, _):
            caught.append(run)
            return self

    monkeypatch.setattr(workers, "give_back", lambda: calls.append(1))
    monkeypatch.setattr(packing, "_repacked", lambda *_: None)
    monkeypatch.setattr(packing, "materialised", lambda *_: None)
    jaccard.set_names(Docs(), "doc_id")
    jaccard._members(Docs(), 1)
    jaccard._support(Docs(), 1, 75)
    jaccard._survivors(Docs(), 1, 75)
    packing.packed(Docs(), TOKENIZER)
    for run in caught[:4]:
        assert list(run(iter([]))) == []
    assert len(caught) == 5 and len(calls) == 4
    monkeypatch.setattr(packing, "TaskContext", type("Context", (), {"get": classmethod(lambda c: c), "partitionId": classmethod(lambda c: 0)}))
    assert list(caught[4](iter([]))) == [] and len(calls) == 5


def test_jaccard_many_small_sets(spark, monkeypatch):
    """More sets than a task numbers at a time."""
    monkeypatch.setattr(jaccard, "PART", 50_000)
    n = 3 * 32768 + 5
    docs = spark.range(0, n, 1, 1).selectExpr("id AS doc_id", "concat('w', id div 2, ' only') AS text")
    got = {r.doc_id: r.component_id for r in jaccard.classes(docs).collect()}
    assert got == {k: k - k % 2 for k in range(n)}


def test_new_pieces_are_found_as_the_text_is_gone_through():
    encoder = WordEncoder(TOKENIZER)
    encoder.known.clear()
    calls, plain = [], encoder.known.find
    encoder.known.find = lambda piece: (calls.append(piece), plain(piece))[1]
    texts = ["Straße, straße and it's 12 more; and", None, "and more of it's straße", "日本 and it's"]
    assert list(encoder.encode(texts)) == encoder._whole([t or "" for t in texts])
    assert calls == ["straße", ",", "and", "it", "'s", "1", "2", "more", ";", "of"]


@pytest.mark.parametrize("n", [0, 1, 64, 1000, 70_001, 300_000])
def test_lanes_against_one_number_at_a_time(n):
    """Every lane's coded state is that of plain integers."""
    ids = np.random.default_rng(n).integers(0, 50, n).astype("<u4") ** 2
    coder = ans.Coder(ans.frequencies(np.bincount(ids, minlength=2402)))
    before, coded = ids.copy(), coder.encode(ids)
    assert (ids == before).all() and (coder.decode(coded) == ids).all()
    lanes = min(ans.LANES, max(1, n // 64))
    states = np.frombuffer(coded, "<u8", lanes, ans.HEAD_BYTES).tolist()
    for k in {0, lanes // 2, lanes - 1}:
        x = int(ans.LOW)
        for i in reversed(ids[k::lanes].tolist()):
            f, c = int(coder.freq[i]), int(coder.cum[i])
            x = x >> 32 if x >= f << 63 - ans.SCALE else x
            x = (x // f << ans.SCALE) + x % f + c
        assert states[k] == x
