"""URL verdicts: rules by longest match, and a walk over the host graph for all other pages.

Host graph: an edge from the page's host to each host its absolute or scheme-relative ``href`` links
name, with the number of such links as weight, and an edge each way between a host and the next
longer suffix of it (``a.b.example`` and ``b.example``), with weight one. A suffix of which no page
is known joins nothing unless it has one child only: owners under a shared suffix (``co.uk``) are
strangers. Relative links stay on their host and add no edge.

Trust is a personalised PageRank from hosts with an allowed page; distrust the same from hosts with
a blocked page, over reversed edges (who links to bad hosts earns distrust). Both start at seeds by
their pages, both walk in one frame, until a round of ``STRIDE`` steps changes all scores together
by at most ``tolerance``, which bounds what is still to come. A host is blocked if its distrust is
above ``ratio`` times its trust (by more than rounding); without either it is allowed.

Defined results: a NULL url or one without ``://`` has an empty host and path, fits no rule, has no
edges and is allowed. NULL html has no links. Repeated pages count as often as they occur. An empty
table gives no rows. Extra columns stay, but for the names added, which replace theirs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.words import ascii_lower, has_column
from tidewheel.sources.sinks import Scratch

ADDED = ("host", "path", "rule", "verdict")
DAMPING = 0.85
#: Steps between two written tables; every step shrinks what is still to come to DAMPING of it.
STRIDE = 5
#: A relative difference below this is rounding.
ROUNDING = 1e-9


class NotSettled(RuntimeError):
    """The walk did not settle within its limit of steps."""


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for NULL or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = ascii_lower(F.regexp_extract(rest, r"(?s)\A([^/?#]*)", 1))
    return host, F.regexp_extract(rest, r"(?s)\A[^/?#]*([^?#]*)", 1)


def rule_verdict(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Struct ``rule, verdict`` of the longest rule that fits, or NULL. A rule is ``(verdict, host/path)``."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        name, _, tail = rule.partition("/")
        fits = (host == name) | host.endswith(f".{name}")
        if tail:
            fits = fits & path.startswith(f"/{tail}")
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def host_edges(pages: DataFrame) -> DataFrame:
    """``src, dst, weight`` from links in ``html`` and from host suffixes; combined in each task first."""
    hrefs = F.regexp_extract_all("html", F.lit(r"""(?i)href\s*=\s*["']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'>\s]+)"""), 1)
    links = (
        pages.where(F.col("html").contains("//"))
        .select(F.col("host").alias("src"), F.explode(F.transform(hrefs, ascii_lower)).alias("dst"))
        .where("src <> '' AND dst <> '' AND src <> dst")
        .groupBy("src", "dst")
        .agg(F.count("*").cast("double").alias("weight"))
    )
    present = pages.where("host <> ''").select("host").distinct()
    labels = F.split("host", r"\.", -1)
    chain = F.transform(  # the host, then each ancestor of at least two labels
        F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(labels) - 1)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    steps = present.select(chain.alias("c")).select(
        F.explode(F.expr("transform(slice(c, 1, greatest(size(c) - 1, 0)), (h, i) -> struct(h as src, c[i + 1] as dst))")).alias("e")
    ).select("e.*").distinct()
    # a parent without a page joins a single child to what lies above it, never children to each other
    joined = (
        steps.groupBy("dst").agg(F.count("*").alias("n")).join(present.select(F.col("host").alias("dst"), F.lit(True).alias("known")), "dst", "left")
        .where("known OR n = 1").select("dst")
    )
    steps = steps.join(joined, "dst").select("src", "dst")
    both = steps.unionByName(steps.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    return links.unionByName(both.withColumn("weight", F.lit(1.0))).groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def spread(edges: DataFrame, seeds: DataFrame, tolerance: float = 1e-6, most: int = 1000, kept: Scratch | None = None) -> DataFrame:
    """``host, trust, distrust`` of the settled walk. ``seeds``: ``host, trust, distrust`` page counts.

    Every step is one join and one sum over edges of both directions; the share a host sends along
    an edge is fixed, so it is computed once. Each round of steps is written to the shared folder,
    with the scores before it at its side, and one number, the change, comes back. Steps beyond
    ``most`` raise :class:`NotSettled`; the change shrinks by ``DAMPING`` a step at least, so only a
    tolerance near the rounding of doubles gets there.
    """
    kept = kept or Scratch()
    sums = seeds.agg(F.sum("trust").alias("t"), F.sum("distrust").alias("d"))
    start = kept.write(
        seeds.crossJoin(F.broadcast(sums)).select(  # one row
            "host",
            F.when(F.col("t") > 0, F.col("trust") / F.col("t")).otherwise(0.0).alias("trust"),
            F.when(F.col("d") > 0, F.col("distrust") / F.col("d")).otherwise(0.0).alias("distrust"),
        ),
        "seeds",
    )
    forth = edges.select("src", "dst", "weight", F.lit(True).alias("forth"))
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight", F.lit(False).alias("forth"))
    ways = forth.unionByName(back)
    out = ways.groupBy("src", "forth").agg(F.sum("weight").alias("all"))
    ways = kept.write(
        ways.join(out, ["src", "forth"]).select("src", "dst", "forth", (F.col("weight") / F.col("all")).alias("share")), "ways"
    )
    score = lambda name: F.sum(name).alias(name)
    restart = start.select("host", *[(F.col(c) * (1 - DAMPING)).alias(c) for c in ("trust", "distrust")])

    def sent(now: DataFrame) -> DataFrame:
        return ways.join(now, ways.src == now.host).select(
            F.col("dst").alias("host"),
            F.when(F.col("forth"), F.col("share") * F.col("trust") * DAMPING).otherwise(0.0).alias("trust"),
            F.when(~F.col("forth"), F.col("share") * F.col("distrust") * DAMPING).otherwise(0.0).alias("distrust"),
        ).unionByName(restart)

    settled = start
    for _ in range(0, most, STRIDE):
        now = settled
        for _ in range(STRIDE - 1):
            now = sent(now).groupBy("host").agg(score("trust"), score("distrust"))
        before = settled.select("host", F.lit(0.0).alias("trust"), F.lit(0.0).alias("distrust"), F.col("trust").alias("trust_was"), F.col("distrust").alias("distrust_was"))
        sides = sent(now).withColumns({"trust_was": F.lit(0.0), "distrust_was": F.lit(0.0)}).unionByName(before)
        last = settled
        settled = kept.write(sides.groupBy("host").agg(*[score(c) for c in ("trust", "distrust", "trust_was", "distrust_was")]), "walk")
        if last is not start:
            kept.drop(last)
        moved = F.abs(F.col("trust") - F.col("trust_was")) + F.abs(F.col("distrust") - F.col("distrust_was"))
        if (settled.agg(F.sum(moved)).first()[0] or 0.0) <= tolerance:
            kept.drop(start, ways)
            return settled.select("host", "trust", "distrust")
    raise NotSettled(f"scores still move after {most} steps")


def judged(pages: DataFrame, rules: Sequence[tuple[str, str]], ratio: float = 1.0, tolerance: float = 1e-6) -> DataFrame:
    """``pages`` with ``host, path, rule, verdict``."""
    has_column(pages, "url", "html")
    host, path = split_url(F.col("url"))
    own = [F.col(f"`{c}`") for c in pages.columns if c not in ADDED]
    ruled = pages.select(*own, host.alias("host"), path.alias("path"))
    ruled = ruled.withColumn("_rule", rule_verdict(F.col("host"), F.col("path"), rules))
    seeds = (
        ruled.where("host <> '' AND _rule IS NOT NULL")
        .groupBy("host")
        .agg(
            F.sum((F.col("_rule.verdict") == "allow").cast("double")).alias("trust"),
            F.sum((F.col("_rule.verdict") == "block").cast("double")).alias("distrust"),
        )
    )
    kept = Scratch()
    edges = kept.write(host_edges(ruled), "host-edges")
    scores = spread(edges, seeds, tolerance, kept=kept)
    kept.drop(edges)
    blocked = scores.where(F.col("distrust") > ratio * F.col("trust") * (1 + ROUNDING)).select(F.col("host").alias("_bad"))
    return ruled.join(blocked, F.col("host") == F.col("_bad"), "left").select(
        *own,
        "host",
        "path",
        F.col("_rule.rule").alias("rule"),
        F.coalesce("_rule.verdict", F.when(F.col("_bad").isNotNull(), "block").otherwise("allow")).alias("verdict"),
    )
