"""Quality rules with risk-controlled cutoffs.

Each rule is a measure of the text and an ordered list of cutoffs, laxest first. On labelled good
documents of a stratum (a language), a cutoff is *valid* if an exact binomial test refutes "it
rejects more than its share of good documents". The level is divided by the number of rules and
strata, and within a rule the cutoffs are tested in their fixed order up to the first failure, so
with probability ``1 - delta`` no valid cutoff anywhere breaks its promise. The shares of the rules
add up to ``alpha``, which bounds what all rules together reject in a stratum. Among the valid
cutoffs the one that rejects most bad documents beyond good ones is used; a rule that rejects no
more bad than good documents is not used.

Defined results: a NULL or empty text has no words and fails the base rules. A NULL stratum is a
stratum of its own. A document labelled more than once counts once, with its lowest label. Labels
without a document, or with a NULL label, are ignored. Without enough labels no cutoff is valid and
only the base rules reject. Repeated rows are judged alike. Extra columns stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.words import brought_back, has_column, set_aside, total, words_of
from tidewheel.sources.sinks import materialised

WINDOW = 8
MEASURES = "_quality"

#: Rule -> cutoffs in percent, laxest first; a document is rejected above its cutoff.
CUTOFFS: dict[str, tuple[int, ...]] = {
    "symbols": (40, 30, 25, 20, 15, 12, 10, 8, 6, 5, 4, 3, 2, 1),
    "dup_lines": (90, 75, 60, 50, 40, 30, 25, 20, 15, 10, 5),
    "repeats": (28, 25, 20, 15, 10, 5, 2),
    "capitals": (95, 90, 80, 70, 60, 50, 40, 30, 25, 20),
}


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` and one struct of counts and shares, all within the row: no shuffle.

    Windows that occur twice are found by sorting the hashes of one text's windows together with
    their places; the words they cover are the gaps between the places, at most a window each.
    """
    has_column(docs, "text")
    keep = [F.col(f"`{c}`") for c in docs.columns]
    text = F.coalesce(F.col("text"), F.lit(""))
    step = docs.select(*keep, words_of(F.col("text")).alias("_w"))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    step = step.select(
        *keep, "_w", lines.alias("_lines"), F.transform("_w", lambda w: F.xxhash64(w)).alias("_wh")
    )
    # hashes of 2, 4 and 8 words from each place on, each from two of the one before
    pair = lambda name, gap: F.transform(name, lambda h, i: F.xxhash64(h, F.get(name, i + F.lit(gap))))
    step = step.select(*keep, "_w", "_lines", pair("_wh", 1).alias("_h2"))
    step = step.select(*keep, "_w", "_lines", pair("_h2", 2).alias("_h4"))
    step = step.select(*keep, "_w", "_lines", pair("_h4", 4).alias("_h8"))
    hashes = F.slice("_h8", 1, F.greatest(F.lit(0), F.size("_w") - (WINDOW - 1)))
    step = step.select(
        *keep,
        F.struct(
            F.size("_w").cast("long").alias("n_words"),
            F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
            F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
            F.size("_lines").cast("long").alias("n_lines"),
            (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
            F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long").alias("n_capitals"),
        ).alias("_c"),
        hashes.alias("_h"),
    )
    placed = F.when(
        F.size(F.array_distinct("_h")) < F.size("_h"),
        F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("p")))),
    ).otherwise(F.array().cast("array<struct<h:bigint,p:int>>"))
    step = step.select(*keep, "_c", placed.alias("_s"))
    twice = F.filter(
        "_s",
        lambda x, i: F.coalesce(F.get("_s", i - 1)["h"] == x["h"], F.lit(False))
        | F.coalesce(F.get("_s", i + 1)["h"] == x["h"], F.lit(False)),
    )
    step = step.select(*keep, "_c", F.sort_array(F.transform(twice, lambda x: x["p"])).alias("_p"))
    covered = total(
        F.transform(
            "_p",
            lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get("_p", i + 1) - p, F.lit(WINDOW))).cast("long"),
        )
    )
    step = step.select(*keep, "_c", covered.alias("_r"))
    share = lambda a, b: F.when(b > 0, 100.0 * a / b).otherwise(F.lit(0.0))
    c = lambda name: F.col(f"_c.{name}")
    return step.select(
        *keep,
        F.struct(
            c("n_words").alias("n_words"),
            c("word_chars").alias("word_chars"),
            c("n_symbols").alias("n_symbols"),
            c("n_dup_lines").alias("n_dup_lines"),
            F.col("_r").alias("n_repeat_words"),
            ((c("n_words") < 20) | (100 * F.col("_r") > 30 * c("n_words"))).alias("base_failed"),
            F.struct(
                share(c("n_symbols"), c("word_chars")).alias("symbols"),
                share(c("n_dup_lines"), c("n_lines")).alias("dup_lines"),
                share(F.col("_r"), c("n_words")).alias("repeats"),
                share(c("n_capitals"), c("word_chars")).alias("capitals"),
            ).alias("shares"),
        ).alias(MEASURES),
    )


def _log_factorial(x: Column) -> Column:
    """Stirling's series from 10 on (error below 1e-11), the product below that."""
    y = F.greatest(x, F.lit(1.0))
    series = (
        y * F.ln(y) - y + 0.5 * F.ln(F.lit(6.283185307179586) * y) + 1 / (12 * y) - 1 / (360 * y * y * y)
        + 1 / (1260 * y * y * y * y * y)
    )
    small = F.aggregate(
        F.sequence(F.lit(1), F.greatest(F.lit(1), F.least(F.lit(10), x.cast("int")))),
        F.lit(0.0),
        lambda a, i: a + F.ln(i.cast("double")),
    )
    return F.when(x < 10, small).otherwise(series)


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """P(X <= k) for X ~ Bin(n, p), for k below n * p; else 1.0 (such a cutoff is never valid).

    Terms are summed from the largest down; they fall at least geometrically, and those more than
    40 standard deviations below it are less than the last bit of the sum.
    """
    n, k = n.cast("double"), k.cast("double")
    top = (
        _log_factorial(n) - _log_factorial(k) - _log_factorial(n - k)
        + k * F.ln(F.lit(p)) + (n - k) * F.ln(F.lit(1.0 - p))
    )
    steps = F.least(k, 40 * F.sqrt(n * p) + 100).cast("int")
    zero = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"), k.alias("i"))

    def down(a, _):
        term = a["term"] * a["i"] / (n - a["i"] + 1) * ((1.0 - p) / p)
        return F.struct(term.alias("term"), (a["sum"] + term).alias("sum"), (a["i"] - 1).alias("i"))

    summed = F.when(steps < 1, F.lit(1.0)).otherwise(
        F.aggregate(F.sequence(F.lit(1), F.greatest(steps, F.lit(1))), zero, down)["sum"]
    )
    return F.when(k >= n * p, F.lit(1.0)).otherwise(F.exp(top) * summed)


def fit_cutoffs(
    scored: DataFrame, labels: DataFrame, stratum: str = "lang", alpha: float = 0.05, delta: float = 0.1
) -> DataFrame:
    """One row per stratum and used rule: ``stratum, rule, cutoff, n_good, n_false``.

    Only counts of labelled rows are shuffled, combined in each task first.
    """
    has_column(scored, "doc_id", stratum, MEASURES)
    has_column(labels, "doc_id", "quality")
    marked = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("good"))
    base = scored.where(~F.col(f"{MEASURES}.base_failed")).select(
        F.col("doc_id"), F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"), F.col(f"{MEASURES}.shares").alias("shares")
    )
    held = base.join(marked, "doc_id")
    hits = F.array(
        *[
            F.struct(
                F.lit(rule).alias("rule"),
                # how many of the rule's cutoffs reject this document
                sum((F.col(f"shares.{rule}") > c).cast("int") for c in cuts).alias("depth"),
            )
            for rule, cuts in CUTOFFS.items()
        ]
    )
    depths = (
        held.select("stratum", "good", F.explode(hits).alias("x"))
        .groupBy("stratum", "x.rule", "x.depth")
        .agg(F.sum((F.col("good") > 0).cast("long")).alias("good"), F.sum((F.col("good") <= 0).cast("long")).alias("bad"))
    )
    per_rule = depths.groupBy("stratum", "rule").agg(
        F.sum("good").alias("n_good"), F.collect_list(F.struct("depth", "good", "bad")).alias("found")
    )  # at most one entry for each cutoff and one more
    tries = F.create_map(*[x for r, cuts in CUTOFFS.items() for x in (F.lit(r), F.array(*[F.lit(c) for c in cuts]))])
    # a document that d of a rule's cutoffs reject is rejected by its d strictest
    above = lambda name: F.aggregate(
        F.filter("found", lambda f: f["depth"] >= F.col("n_cuts") - F.col("i")), F.lit(0).cast("long"), lambda a, f: a + f[name]
    )
    tested = per_rule.select(
        "stratum", "rule", "n_good", "found", F.size(tries[F.col("rule")]).alias("n_cuts"),
        F.posexplode(tries[F.col("rule")]).alias("i", "cutoff"),
    ).select("stratum", "rule", "n_good", "i", "cutoff", above("good").alias("n_false"), above("bad").alias("n_true"))
    strata = depths.select("stratum").distinct().agg(F.count("*").alias("n_strata"))
    level = F.lit(delta) / (len(CUTOFFS) * F.col("n_strata"))
    judged = tested.crossJoin(F.broadcast(strata)).select(  # one row
        "*", (binomial_tail(F.col("n_good"), F.col("n_false"), alpha / len(CUTOFFS)) <= level).alias("valid")
    )
    # counts rise with i, so the valid cutoffs are the ones before the first failure
    return (
        judged.where("valid AND n_true > n_false")
        .groupBy("stratum", "rule")
        .agg(F.max_by(F.struct("cutoff", "n_good", "n_false"), F.struct(F.col("n_true") - F.col("n_false"), -F.col("i"))).alias("best"))
        .select("stratum", "rule", "best.*")
    )


def judged(docs: DataFrame, labels: DataFrame, stratum: str = "lang", alpha: float = 0.05, delta: float = 0.1) -> DataFrame:
    """``docs``, the struct of measures, and ``_kept``.

    The measures are computed once and written with the rows; labels meet only their numbers.
    """
    scored = materialised(measured(docs), "quality")
    cuts = fit_cutoffs(scored, labels, stratum, alpha, delta)
    wide = materialised(
        cuts.groupBy("stratum").agg(*[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(r) for r in CUTOFFS]), "cutoffs"
    )
    wide = wide.select(F.col("stratum").alias("_stratum"), F.struct(*CUTOFFS).alias("_cuts"))
    rejected = F.lit(False)
    for rule in CUTOFFS:
        rejected = rejected | F.coalesce(F.col(f"{MEASURES}.shares.{rule}") > F.col(f"_cuts.{rule}"), F.lit(False))
    own = [F.col(f"`{c}`") for c in docs.columns]
    return scored.join(
        wide, F.coalesce(F.col(f"`{stratum}`").cast("string"), F.lit("")) == F.col("_stratum"), "left"
    ).select(*own, MEASURES, (~(F.col(f"{MEASURES}.base_failed") | rejected)).alias("_kept"))


def kept(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that pass, with their own columns."""
    read = list(dict.fromkeys(["doc_id", "text", options.get("stratum", "lang")]))
    has_column(docs, *read)
    passed = judged(set_aside(docs, *read), labels, **options).where("_kept")
    return passed.select(*brought_back(docs.columns, **{c: F.col(c) for c in read}))
