"""Benchmark decontamination by template windows.

Canonical form: numbers, units after a number and names (capitalised words inside a sentence) become
typed placeholders; the other words are lower-cased and lose punctuation. Windows of eight canonical
words are hashed and joined with the benchmark's by hash. A document is suspect of an item if it holds
at least ``NEEDED`` different windows of it (thirteen words in a row give six), or all of a shorter
one. Then the slots of the matched windows are compared side by side. A pair is kept if, per type, at
least ``AGREEING`` of the slots hold the value that their item value mostly stands for and at most two
item values stand for one value; or if at least ``EQUAL`` of the numbers and names are the item's own;
or if at least ``LITERAL`` of the item's words are in the document as they are. A question with new
numbers or names passes this (it is caught, with ``reworded`` true), and so does a copy with some values
edited; chance matches of empty templates do not.

The first word of an item has nothing before it that tells a name; a capitalised one is sought as a
word and as a name, and where it meets a name it is a slot. In items below eight words it must then be
the same word.

Documents are read once for the windows; only (place, hash) leaves a row, and only matches are
shuffled. The texts of suspects alone are cut into words again for the slots. Suspects and leaks find
their texts by a broadcast of row numbers if these measure up to 64 MB; beyond, the texts are shuffled.

The benchmark's windows are broadcast if they are at most ``BROADCAST_ROWS``, else joined by shuffle.

Defined results: NULL and empty texts and items match nothing. Items below eight words are matched
whole, by windows of their own length. Repeated rows give repeated results, equal items (same text)
each give a row. Extra columns stay in ``cleaned`` and are not read in ``leaks``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.words import brought_back, has_column, set_aside
from tidewheel.sources.sinks import broadcast_hint, materialised

WINDOW = 8
NEEDED = 6
BROADCAST_ROWS = 1_000_000
AGREEING, EQUAL, LITERAL = 0.75, 0.5, 0.8
MARK = "\u0001"
FIRST_NAME = r"\A\s*(\p{Lu}\p{Ll}+)(?![\p{L}\p{N}])"

# Units that may follow a number.
UNITS = (
    "%", "km", "m", "cm", "mm", "mi", "miles", "mile", "feet", "ft", "inches", "inch", "meters", "metres", "kilometers",
    "kg", "g", "mg", "pounds", "lb", "lbs", "ounces", "grams", "kilograms", "l", "ml", "liters", "litres", "gallons", "cups",
    "hours", "hour", "h", "minutes", "minute", "min", "seconds", "second", "s", "days", "day", "weeks", "week", "months",
    "month", "years", "year", "dollars", "dollar", "cents", "euros", "euro", "percent", "degrees", "mph", "kmh",
)


def slotted_words(text: Column) -> Column:
    """Canonical words; a slot is ``\\u0001``, its type (``d`` number, ``u`` unit, ``n`` name) and its value."""
    t = F.regexp_replace(F.coalesce(text, F.lit("")), f"{MARK}+", " ")
    units = "|".join(u.replace("%", "%(?!\\S)") if u == "%" else f"{u}(?![\\p{{L}}\\p{{N}}])" for u in sorted(UNITS, key=lambda u: -len(u)))
    t = F.regexp_replace(t, rf"(?<=[0-9]) ?({units})", f" {MARK}u$1 ")
    t = F.regexp_replace(t, r"(?<![\p{L}\p{N}" + MARK + r"])([0-9]+(?:[.,][0-9]+)*+)", f"{MARK}d$1")
    t = F.regexp_replace(t, r"(?<=[\p{Ll}\p{N},;:)] )(\p{Lu}\p{Ll}+)(?![\p{L}\p{N}])", f"{MARK}n$1")
    t = F.regexp_replace(F.lower(t), r"(?<=[0-9])[.,](?=[0-9])", "_")
    t = F.regexp_replace(t, rf"[^\p{{L}}\p{{N}}_%{MARK}]+", " ")
    return F.filter(F.split(t, " ", -1), lambda w: w != "")


def _template(word: Column) -> Column:
    return F.when(F.startswith(word, F.lit(MARK)), F.substring(word, 1, 2)).otherwise(word)


def _joined(name: str, gap: int) -> Column:
    return F.zip_with(name, F.slice(name, 1 + gap, F.greatest(F.lit(0), F.size(name) - gap)), lambda a, b: F.xxhash64(a, b))


def _hashes(df: DataFrame, keep: list[Column], words: str, length: int) -> DataFrame:
    """``keep`` and ``_h``: hashes of all windows of ``length`` words, by doubling where that is eight."""
    first = df.select(*keep, F.size(words).alias("_n"), F.transform(words, lambda w: F.xxhash64(_template(w))).alias("_a"))
    if length == 8:
        for name, new, gap in (("_a", "_b", 1), ("_b", "_c", 2), ("_c", "_a", 4)):
            first = first.select(*keep, "_n", _joined(name, gap).alias(new))
    else:
        first = first.select(
            *keep, "_n",
            F.transform(
                F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("_a"))), lambda i: F.xxhash64(F.array_join(F.slice("_a", i, length).cast("array<string>"), " "))
            ).alias("_a"),
        )
    return first.select(*keep, F.slice("_a", 1, F.greatest(F.lit(0), F.col("_n") - (length - 1))).alias("_h"))


def _windows(df: DataFrame, keep: list[Column], length: int) -> DataFrame:
    # outer: the filter that a plain posexplode pushes down would form all hashes twice
    return _hashes(df, keep, "_w", length).select(*keep, F.posexplode_outer("_h").alias("_at", "_hash"))


def _named(words: str, first: str) -> Column:
    """``words`` with the first one as a name."""
    return F.concat(F.array(F.concat(F.lit(f"{MARK}n"), F.col(first))), F.slice(words, 2, F.greatest(F.lit(1), F.size(words))))


def leaks(docs: DataFrame, benchmark: DataFrame, needed: int = NEEDED) -> DataFrame:
    """``doc_id, item_id, n_windows, n_matched, n_slots, reworded``, one row per document and leaked item."""
    return _leaks(_numbered(docs), benchmark, needed).drop("_row")


def _numbered(docs: DataFrame) -> DataFrame:
    has_column(docs, "doc_id", "text")
    return docs.select("doc_id", "text", F.monotonically_increasing_id().alias("_row"))


def _leaks(numbered: DataFrame, benchmark: DataFrame, needed: int) -> DataFrame:
    has_column(benchmark, "item_id", "text")
    items = benchmark.select(
        "item_id", F.monotonically_increasing_id().alias("_item"), slotted_words(F.col("text")).alias("_iw"),
        F.lower(F.regexp_extract(F.coalesce("text", F.lit("")), FIRST_NAME, 1)).alias("_first"),
    )
    items = materialised(items.where(F.size("_iw") > 0), "items")
    lengths = [r[0] for r in items.select(F.least(F.lit(WINDOW), F.size("_iw")).alias("n")).distinct().collect()]  # 1 to 8
    worded = numbered.where(F.col("text") != "").select("doc_id", "_row", slotted_words(F.col("text")).alias("_w"))
    found = None
    for length in lengths:
        own = items.where(F.size("_iw") >= WINDOW) if length == WINDOW else items.where(F.size("_iw") == length)
        sought = _hashes(own, [F.col("_item")], "_iw", length).select(
            "_item", F.size("_h").alias("_n"), F.posexplode("_h").alias("_in", "_hash")
        )
        named = own.where("_first <> ''").select("_item", _named("_iw", "_first").alias("_iw"))
        named = _hashes(named, [F.col("_item")], "_iw", length).select("_item", F.size("_h").alias("_n"), F.posexplode("_h").alias("_in", "_hash"))
        sought = sought.unionByName(named.where("_in = 0"))
        if sought.count() <= BROADCAST_ROWS:
            sought = F.broadcast(sought)
        hit = _windows(worded, [F.col("doc_id"), F.col("_row")], length).join(sought, "_hash")
        hit = hit.select("doc_id", "_row", "_item", "_n", "_at", "_in", F.lit(length).alias("_length"))
        found = hit if found is None else found.unionByName(hit)
    if found is None:
        found = numbered.limit(0).select(
            "doc_id", "_row", *[F.lit(0).cast(t).alias(c) for c, t in (("_item", "long"), ("_n", "int"), ("_at", "int"), ("_in", "int"), ("_length", "int"))]
        )
    found = materialised(found, "windows")
    enough = (
        found.groupBy("_row", "_item")
        .agg(F.max("_n").alias("_n"), F.countDistinct("_in").alias("_m"))
        .where(F.col("_m") >= F.least(F.lit(needed), F.col("_n")))
    )
    suspects = materialised(found.join(enough.select("_row", "_item", "_m"), ["_row", "_item"]), "suspects")
    slots = _slots(suspects, numbered, items)
    pairs = suspects.groupBy("_row", "_item").agg(
        F.first("doc_id").alias("doc_id"), F.max("_n").alias("n_windows"), F.max("_m").alias("n_matched")
    )
    return (
        pairs.join(slots, ["_row", "_item"], "left")
        .join(items.select("_item", "item_id"), "_item")
        .select(
            "doc_id", "item_id", "_row", F.col("n_windows").cast("long"), F.col("n_matched").cast("long"),
            F.coalesce("n_slots", F.lit(0)).cast("long").alias("n_slots"), F.coalesce("reworded", F.lit(False)).alias("reworded"),
            F.coalesce("consistent", F.lit(True)).alias("consistent"),
        )
        .where("consistent")
        .drop("consistent")
    )


def _slots(suspects: DataFrame, numbered: DataFrame, items: DataFrame) -> DataFrame:
    """For each suspect pair with slots: ``n_slots, consistent, reworded``.

    A slot position of the item and the document's slot across from it are one line each, told
    apart per alignment (where the item would start in the document), so that two copies of an item
    with different values in one document are each judged by themselves; one consistent copy is enough.
    """
    mapped = lambda c: F.filter(
        F.transform(c, lambda w, i: F.struct(i.alias("i"), w.alias("w"))), lambda x: F.startswith(x["w"], F.lit(MARK))
    )
    named = F.when(F.col("_first") != "", _named("_iw", "_first")).otherwise(F.col("_iw"))
    item_slots = items.withColumn("_iw", named).select("_item", F.explode(mapped("_iw")).alias("s")).select("_item", F.col("s.i").alias("_in"), F.col("s.w").alias("_iv"))
    # item places that matched windows cover, and their place in the document
    covered = suspects.select(
        "_row", "_item", (F.col("_at") - F.col("_in")).alias("_shift"),
        F.explode(F.expr("sequence(_in, _in + _length - 1)")).alias("_in"),
    ).distinct()
    across = covered.join(item_slots, ["_item", "_in"])
    rows = materialised(across.select("_row").distinct(), "slotted")
    texts = numbered.join(broadcast_hint(rows)(rows), "_row", "left_semi").select("_row", slotted_words(F.col("text")).alias("_w"))
    doc_slots = texts.select("_row", F.explode(mapped("_w")).alias("s")).select("_row", F.col("s.i").alias("_at"), F.col("s.w").alias("_dv"))
    lines = across.join(
        doc_slots, (across["_row"] == doc_slots["_row"]) & (across["_in"] + across["_shift"] == doc_slots["_at"])
    ).select(across["_row"], "_item", "_shift", "_in", "_iv", "_dv")
    place = ["_row", "_item", "_shift"]
    values = lines.groupBy(*place, F.substring("_iv", 2, 1).alias("type"), "_iv", "_dv").agg(
        F.count("*").alias("n"), F.max((F.col("_in") == 0) & (F.col("_iv") != F.col("_dv"))).alias("other")
    )
    of_item = values.groupBy(*place, "type", "_iv").agg(
        F.sum("n").alias("n"), F.max("n").alias("most"), F.max("other").alias("other"), F.sum(F.when(F.col("_iv") == F.col("_dv"), F.col("n")).otherwise(0)).alias("same")
    )
    doc_values = values.groupBy(*place, "type").agg(F.countDistinct("_dv").alias("dv"))
    types = of_item.groupBy(*place, "type").agg(
        F.sum("n").alias("n"), F.sum("most").alias("most"), F.sum("same").alias("same"), F.count("*").alias("iv"), F.max("other").alias("other")
    ).join(doc_values, [*place, "type"])
    fit = (F.col("most") >= AGREEING * F.col("n")) & (2 * F.col("dv") >= F.col("iv"))
    own = F.col("type") != "u"
    judged = types.groupBy(*place).agg(
        F.sum("n").alias("n"), F.sum("same").alias("same"), F.min(fit).alias("fit"),
        F.max("other").alias("other"),
        F.sum(F.when(own, F.col("n")).otherwise(0)).alias("n_own"), F.sum(F.when(own, F.col("same")).otherwise(0)).alias("same_own"),
    )
    words = covered.groupBy(*place).agg(F.count("*").alias("n_words")).join(items.select("_item", F.size("_iw").alias("_all"), (F.col("_first") != "").alias("_may")), "_item")
    ok = (
        F.col("fit")
        | ((F.col("n_own") > 0) & (F.col("same_own") >= EQUAL * F.col("n_own")))
        | (F.col("n_words") - F.col("n") + F.col("same") >= LITERAL * F.col("_all"))
    )
    ok = ok & ~(F.col("other") & F.col("_may") & (F.col("_all") < WINDOW))
    return (
        judged.join(words, place)
        .select("_row", "_item", "n", ok.alias("ok"), (F.col("same") < F.col("n")).alias("new"))
        .groupBy("_row", "_item")
        .agg(
            F.sum("n").alias("n_slots"), F.max("ok").alias("consistent"),
            F.min(F.when(F.col("ok"), F.col("new")).otherwise(True)).alias("reworded"),
        )
    )


def cleaned(docs: DataFrame, benchmark: DataFrame, needed: int = NEEDED) -> DataFrame:
    """``docs`` without documents that hold a benchmark item; all other rows and columns as they are."""
    has_column(docs, "doc_id", "text")
    numbered = set_aside(docs, "doc_id", "text").withColumn("_row", F.monotonically_increasing_id())
    bad = materialised(_leaks(numbered.select("doc_id", "text", "_row"), benchmark, needed).select("_row").distinct(), "leaked")
    rest = numbered.join(broadcast_hint(bad)(bad), "_row", "left_anti")
    return rest.select(*brought_back(docs.columns, doc_id=F.col("doc_id"), text=F.col("text")))
