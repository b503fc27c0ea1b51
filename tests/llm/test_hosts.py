"""Host verdicts against the walk in plain Python, and the shapes of graphs that a short walk would miss."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest

from tidewheel.llm import hosts

RULES = [("allow", "com/"), ("block", "bad.net/")]
SCHEMA = "page_id long, url string, html string"


def verdicts(spark, pages):
    rows = [(n, f"http://{host}/", "".join(f'<a href="http://{h}/">' for h in links)) for n, (host, links) in enumerate(pages)]
    return {r.host: r.verdict for r in hosts.judged(spark.createDataFrame(rows, SCHEMA), RULES).collect()}


def walked(pages, steps=200):
    """Verdicts by a long plain walk."""
    present = {host for host, _ in pages}
    weight = defaultdict(float)
    for host, links in pages:
        for h in links:
            if h != host:
                weight[host, h] += 1
    up = set()
    for host in present:
        labels = host.split(".")
        up |= {(".".join(labels[i:]), ".".join(labels[i + 1 :])) for i in range(len(labels) - 2)}
    for child, parent in up:
        if parent in present or sum(p == parent for _, p in up) == 1:
            weight[child, parent] += 1
            weight[parent, child] += 1

    def ranks(seeds, edges):
        out, total = defaultdict(float), sum(seeds.values())
        for (a, _), w in edges.items():
            out[a] += w
        start = {h: n / total for h, n in seeds.items()} if total else {}
        now = dict(start)
        for _ in range(steps):
            new = defaultdict(float, {h: 0.15 * v for h, v in start.items()})
            for (a, b), w in edges.items():
                new[b] += 0.85 * now.get(a, 0.0) * w / out[a]
            now = new
        return now

    allowed, blocked = defaultdict(int), defaultdict(int)
    for host, _ in pages:
        if host.endswith(".com"):
            allowed[host] += 1
        elif host == "bad.net" or host.endswith(".bad.net"):
            blocked[host] += 1
    trust = ranks(allowed, weight)
    distrust = ranks(blocked, {(b, a): w for (a, b), w in weight.items()})
    ruled = {h: "allow" for h in allowed} | {h: "block" for h in blocked}
    return {h: ruled.get(h) or ("block" if distrust.get(h, 0) > trust.get(h, 0) * (1 + 1e-9) else "allow") for h in present}


def test_long_chain_is_blocked_to_its_start(spark):
    chain = [f"h{k}.org" for k in range(15)]
    pages = [(h, [after]) for h, after in zip(chain, [*chain[1:], "bad.net"], strict=True)] + [("bad.net", []), ("alone.org", [])]
    got = verdicts(spark, pages)
    assert all(got[h] == "block" for h in chain) and got["alone.org"] == "allow" and got == walked(pages)


def test_owners_under_a_shared_suffix_are_strangers(spark):
    pages = [("spam.co.uk", ["bad.net"]), ("school.co.uk", []), ("bad.net", []), ("a.shop.co.uk", ["bad.net"]), ("shop.co.uk", [])]
    got = verdicts(spark, pages)
    assert got["spam.co.uk"] == "block" and got["school.co.uk"] == "allow" and got["shop.co.uk"] == "block"


def test_repeated_links_count_as_often_as_they_occur(spark):
    edges = hosts.host_edges(spark.createDataFrame([("a.org", '<a href="//b.org"><a href="http://B.org/x"><a href="//c.org">')], "host string, html string"))
    assert {(r.src, r.dst): r.weight for r in edges.collect()} == {("a.org", "b.org"): 2.0, ("a.org", "c.org"): 1.0}


@pytest.mark.parametrize("seed", [1, 2])
def test_random_graphs(spark, seed):
    rng = random.Random(seed)
    names = [f"s{k}.org" for k in range(25)] + [f"x.s{k}.org" for k in range(5)] + ["good.com", "fine.com", "bad.net", "x.bad.net"]
    pages = [(h, rng.sample(names, rng.randrange(4)) * rng.choice([1, 2])) for h in names for _ in range(rng.choice([1, 1, 2]))]
    assert verdicts(spark, pages) == walked(pages)


def test_a_walk_that_cannot_settle_says_so(spark):
    edges = spark.createDataFrame([("a", "b", 1.0), ("b", "a", 1.0)], "src string, dst string, weight double")
    seeds = spark.createDataFrame([("a", 1.0, 0.0)], "host string, trust double, distrust double")
    with pytest.raises(hosts.NotSettled):
        hosts.spread(edges, seeds, tolerance=1e-6, most=10)
