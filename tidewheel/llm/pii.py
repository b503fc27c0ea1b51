"""Personal data: base patterns, and bootstrapped contexts that find more.

Base kinds (e-mail, IPv4 address, payment card, phone) are regular expressions with checks; matches
of one kind do not overlap, kinds may. Places come from cutting the text at the matches: a match
starts where the lengths of all cuts and matches before it add up to.

Bootstrapping looks at *tokens* (runs between spaces, ends trimmed of punctuation, a glued ``name=``
or ``name:`` cut off) of six code points or more that hold a digit or a lone ``@``, and at their
*patterns*: the word before, the two words before, the words on both sides, and the two words after.
``=`` is a word of its own, other punctuation is none; words count within ``REACH`` code points.
Patterns do not know the shape of a token, so base matches of any kind can lead to identifiers of
other shapes; shape is only a filter: dates, times, versions and numbers with separators (``PLAIN``)
are never identifiers, but count against a pattern.

Patterns and instances (token texts) form a two-sided graph. Base matches are known with score one. A
pattern's score is the share of its instances' scores, smoothed, over its different instances; it is
confident from ``threshold`` on, with ``support`` different known instances. Instances of confident
patterns become known with the best of their patterns' scores, and then support further patterns.
That repeats until no instance becomes known; scores fall with each hop, and known ones do not
change, so it ends. Tokens of a confident pattern are identifiers of kind ``context``, wherever they
occur in that pattern.

Only tokens with an identifier's look leave a row; pairs are counted in each task first, and the
graph has one edge per different pair.

Defined results: NULL is the empty text and has no span. Spans count code points, ends exclusive. A
found token that overlaps a base span adds nothing. Repeated rows count once per row in ``found`` and
once per different instance in scores. Without seeds nothing is added. Extra columns stay; the struct
``_pii`` is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.words import brought_back, has_column, set_aside
from tidewheel.sources.sinks import broadcast_hint, materialised

KINDS = ("email", "ip", "card", "phone")
CONTEXT = "context"

# Written so that no match needs steps that grow faster than the text: possessive loops, and starts
# only where a run begins or the last match ended. They match what the plain forms match.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    # a whole chain of 12 to 19 digits: other chains would be dropped as soon as they are found
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![0-9])(?![\x20-][0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# A text without these cannot hold the kind.
NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}

TOKEN = r"(?<![^\x20\x09-\x0D])(?=[^\x20\x09-\x0D]*+(?<=[^\x20\x09-\x0D]{6}))[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
# A name and its sign before a value without a space; not a URL, and no part of a chain of colons.
GLUED = r"^(?:[^0-9@]*=|[^0-9@:=]++:(?![^:]*+:))(?!//)"
# Not identifiers, whatever stands around them: separated numbers, dates, times, versions.
PLAIN = (
    r"^(?i)(?:[0-9]{1,3}(?:[.,'][0-9]{3})+(?:[.,][0-9]+)?|[0-9]+[.,][0-9]+|[0-9]{4}[-/.][0-9]{1,2}[-/.][0-9]{1,2}(?:t[0-9:.]+z?)?"
    r"|[0-9]{1,2}[-/.][0-9]{1,2}[-/.][0-9]{2,4}|[0-9]{4}[-/\u2013][0-9]{2,4}|[0-9]{1,2}:[0-9]{2}(?::[0-9]{2})?(?:[.,][0-9]+)?(?:am|pm|z)?"
    r"|v?[0-9]+(?:\.[0-9]+)+(?:[-+.]?[a-z][a-z0-9.]*)?)%?$"
)
REACH = 100
SPANS = "array<struct<start:int,stop:int,text:string,before:string,after:string>>"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]+", "")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)
    doubled = F.transform(
        F.sequence(F.lit(1), n),
        lambda i: F.when((n - i) % 2 == 1, F.substring(digits, i, F.lit(1)).cast("int") * 2).otherwise(
            F.substring(digits, i, F.lit(1)).cast("int")
        ),
    )
    summed = F.aggregate(doubled, F.lit(0), lambda a, x: a + F.when(x > 9, x - 9).otherwise(x))
    return summed % 10 == 0


def _holds(kind: str, text: Column) -> Column:
    """Whether a match of the pattern is of its kind."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        trimmed = F.transform(F.split(text, r"\.", -1), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
        return F.forall(trimmed, lambda p: F.when(F.length(p) <= 3, p.cast("int") <= 255).otherwise(F.lit(False)))
    digits = _digits(text)
    if kind == "card":
        return F.length(digits).between(12, 19) & F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(F.lit(False))
    return F.length(digits).between(9, 15)


def _located(text: Column, pattern: str) -> Column:
    """All matches as ``start, stop, text, before, after``: what stands left and right, up to the next match.

    Cuts and matches alternate, a cut first and last. Texts without a match are only searched once.
    """
    cuts = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), 0)
    n = F.greatest(F.lit(0), F.size(cuts) - 1)
    around = F.zip_with(F.slice(cuts, 1, n), F.slice(cuts, 2, n), lambda c, d: F.struct(c.alias("c"), d.alias("d")))
    pairs = F.zip_with(found, around, lambda m, x: F.struct(x["c"].alias("c"), m.alias("m"), x["d"].alias("d")))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("out"))

    def step(a, x):
        start = a["at"] + F.length(x["c"])
        stop = start + F.length(x["m"])
        before, after = F.substring(x["c"], -REACH, REACH), F.substring(x["d"], 1, REACH)
        one = F.struct(start.alias("start"), stop.alias("stop"), x["m"].alias("text"), before.alias("before"), after.alias("after"))
        return F.struct(stop.alias("at"), F.concat(a["out"], F.array(one)).alias("out"))

    return F.when(text.rlike(pattern), F.aggregate(pairs, zero, step)["out"]).otherwise(F.array().cast(SPANS))


def _words(text: Column) -> Column:
    """Lower-case words with one space between them; ``=`` is a word, other punctuation around words is not."""
    out = F.regexp_replace(F.replace(F.lower(text), F.lit("="), F.lit(" = ")), r"[^\p{L}\p{N}=]*[\x20\x09-\x0D][^\p{L}\p{N}=]*", " ")
    return F.regexp_replace(out, r"^[^\p{L}\p{N}=]+|[^\p{L}\p{N}=]+$", "")


def _patterns(x: Column) -> Column:
    """The patterns a match or token stands in."""
    before, after = x["before"], x["after"]
    last, first = F.substring_index(before, " ", -1), F.substring_index(after, " ", 1)
    listed = F.array(
        F.when((last != "") & (last != "="), F.concat(F.lit("b "), last)),
        F.when(F.contains(before, F.lit(" ")), F.concat(F.lit("bb "), before)),
        F.when((last != "") & (first != ""), F.concat_ws(" ", F.lit("ba"), last, first)),
        F.when(F.contains(after, F.lit(" ")), F.concat(F.lit("aa "), after)),
    )
    return F.filter(listed, lambda p: p.isNotNull())


def _trimmed(token: Column) -> Column:
    """``start, stop, text, before, after`` without a glued name and punctuation at the ends."""
    name = F.regexp_extract(token["text"], GLUED, 0)
    value = F.substring(token["text"], F.length(name) + 1, F.length(token["text"]))
    head = F.length(F.regexp_extract(value, r"^[^\p{L}\p{N}]*", 0))
    tail = F.length(F.regexp_extract(value, r"[^\p{L}\p{N}]*$", 0))
    size = F.greatest(F.lit(0), F.length(value) - head - tail)
    start = token["start"] + F.length(name) + head
    return F.struct(
        start.alias("start"), (start + size).alias("stop"), F.substring(value, head + 1, size).alias("text"),
        _before(F.concat_ws(" ", token["before"], name)).alias("before"), _after(token["after"]).alias("after"),
    )


def _before(text: Column) -> Column:
    return F.substring_index(_words(text), " ", -2)


def _after(text: Column) -> Column:
    return F.substring_index(_words(text), " ", 2)


def spotted(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_pii``: base spans per kind, and identifier-like tokens outside them. Row by row."""
    has_column(docs, "text")
    own = [F.col(f"`{c}`") for c in docs.columns if c != "_pii"]
    text = F.coalesce(F.col("text"), F.lit(""))
    none = F.array().cast(SPANS)
    # first the matches, then what depends on them: each pattern runs once per text
    step = docs.select(
        *own,
        *[F.when(F.contains(text, F.lit(NEEDS[k])), _located(text, PATTERNS[k])).otherwise(none).alias(f"_{k}") for k in KINDS],
        F.when(text.rlike("[0-9@]"), _located(text, TOKEN)).otherwise(none).alias("_token"),
    )
    held = [F.filter(f"_{k}", _keeps(k)).alias(f"_{k}") for k in KINDS]
    step = step.select(*own, *held, F.transform("_token", _trimmed).alias("_token"))
    listed = [F.transform(f"_{k}", _entry(k, i)) for i, k in enumerate(KINDS)]
    step = step.select(*own, F.concat(*listed).alias("_base"), "_token")
    free = F.filter(
        "_token",
        lambda t: (F.length(t["text"]) >= 6)
        & t["text"].rlike("[0-9@]")
        & ~F.exists("_base", lambda b: (b["start"] < t["stop"]) & (t["start"] < b["stop"])),
    )
    return step.select(*own, F.struct(F.col("_base").alias("base"), free.alias("tokens")).alias("_pii"))


def _keeps(kind: str):
    return lambda x: _holds(kind, x["text"])


def _entry(kind: str, order: int):
    return lambda x: F.struct(
        x["start"].alias("start"), F.lit(order).alias("order"), x["stop"].alias("stop"), F.lit(kind).alias("kind"),
        x["text"].alias("text"), _before(x["before"]).alias("before"), _after(x["after"]).alias("after"),
    )


def confident_patterns(spots: DataFrame, threshold: float = 0.6, support: int = 3) -> DataFrame:
    """``pattern`` of those that tell of identifiers, with ``score``. ``spots``: ``_pii``."""
    base = spots.select(F.explode("_pii.base").alias("x")).select("x", F.lit(True).alias("seed"), F.lit(True).alias("may"))
    tokens = spots.select(F.explode("_pii.tokens").alias("x")).select("x", F.lit(False).alias("seed"), _may(F.col("x.text")).alias("may"))
    seen = [s.select(F.explode(_patterns(F.col("x"))).alias("pattern"), F.xxhash64("x.text").alias("instance"), "seed", "may") for s in (base, tokens)]
    # an instance is the same wherever it stands; one that is a seed anywhere is a seed
    edges = seen[0].unionByName(seen[1]).groupBy("pattern", "instance").agg(F.max("seed").alias("seed"), F.max("may").alias("may"))
    edges = materialised(edges, "pii-edges")
    known = materialised(edges.where("seed").select("instance", F.lit(1.0).alias("score")).distinct(), "pii-known")
    while True:
        good = (
            edges.select("pattern", "instance")
            .join(known, "instance", "left")
            .groupBy("pattern")
            .agg((F.sum(F.coalesce("score", F.lit(0.0))) / (F.count("*") + 1)).alias("score"), F.count("score").alias("n_known"))
            .where((F.col("score") >= threshold) & (F.col("n_known") >= support))
            .select("pattern", "score")
        )
        good = materialised(good, "pii-patterns")
        reached = edges.where("may").join(good, "pattern").groupBy("instance").agg(F.max("score").alias("score"))
        fresh = materialised(reached.join(known, "instance", "left_anti"), "pii-reached")
        if fresh.isEmpty():
            return good
        known = materialised(known.unionByName(fresh), "pii-known")


def _may(text: Column) -> Column:
    return ~text.rlike(PLAIN)


def found(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with ``_spans``: all spans ``start, order, stop, kind``, in order; base kinds and ``context``."""
    own = [F.col(f"`{c}`") for c in docs.columns if c not in ("_pii", "_spans")]
    spots = materialised(spotted(docs.select(*own, F.monotonically_increasing_id().alias("_pii_row"))), "pii")
    good = confident_patterns(spots.select("_pii"), **options)
    tokens = spots.select("_pii_row", F.explode("_pii.tokens").alias("x")).where(_may(F.col("x.text"))).select(
        "_pii_row", F.explode(_patterns(F.col("x"))).alias("pattern"), "x.start", "x.stop"
    )
    more = (
        tokens.join(good.select("pattern"), "pattern")
        .groupBy("_pii_row")
        .agg(F.collect_set(F.struct("start", "stop")).alias("_more"))
    )  # at most the tokens of one text
    more = materialised(more, "pii-more")
    more = broadcast_hint(more)(more)  # few rows have any: the texts need not move to meet them
    added = F.transform("_more", lambda m: F.struct(m["start"].alias("start"), F.lit(len(KINDS)).alias("order"), m["stop"].alias("stop"), F.lit(CONTEXT).alias("kind")))
    base = F.transform("_pii.base", lambda b: F.struct(b["start"], b["order"], b["stop"], b["kind"]))
    spans = F.sort_array(F.concat(base, F.coalesce(added, F.array().cast("array<struct<start:int,order:int,stop:int,kind:string>>"))))
    return spots.join(more, "_pii_row", "left").select(*own, spans.alias("_spans"))


def spelled(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def base_only(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["kind"] != CONTEXT)


def masked(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in angle brackets.

    Spans that overlap are masked as one, under the kind of the first. ``n_chars`` follows the text.
    """
    has_column(docs, "text")
    spotted_docs = found(set_aside(docs, "text"), **options)
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(a, s):
        piece = F.substring(F.col("text"), a["at"] + 1, s["start"] - a["at"])
        name = F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">"))
        fresh = F.struct(s["stop"].alias("at"), F.concat(a["parts"], F.array(piece, name)).alias("parts"))
        inside = F.struct(F.greatest(a["at"], s["stop"]).alias("at"), a["parts"].alias("parts"))
        return F.when(s["start"] >= a["at"], fresh).otherwise(inside)

    built = spotted_docs.withColumn("_built", F.when(F.size("_spans") > 0, F.aggregate("_spans", empty, step)))
    text = F.when(
        F.col("_built").isNotNull(),
        F.concat(F.array_join("_built.parts", ""), F.substring(F.col("text"), F.col("_built.at") + 1, F.length("text"))),
    ).otherwise(F.col("text"))
    out = built.withColumn("_masked", text)
    return out.select(*brought_back(docs.columns, text=F.col("_masked"), n_chars=F.length("_masked").cast("long")))
