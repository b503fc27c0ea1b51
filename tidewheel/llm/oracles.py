"""SQL that gives the rows of some queries, for DuckDB over the same tables."""

from __future__ import annotations

from collections.abc import Sequence

from tidewheel.llm import rules


def quality_sql(alpha: float = 0.05, delta: float = 0.1) -> str:
    cuts = ", ".join(f"('{rule}', {i}, {c})" for rule, cs in rules.CUTOFFS.items() for i, c in enumerate(cs))
    share = alpha / len(rules.CUTOFFS)
    nexts = ", ".join(f"lead(x, {k}) OVER o" for k in range(1, rules.WINDOW))
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(lang, '') AS st, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM documents),
 wd AS (SELECT r, unnest(range(len(w))) AS i, unnest(w) AS x FROM d WHERE len(w) >= 8),
 win AS (SELECT r, i, concat_ws(chr(1), x, {nexts}) AS k, lead(x, 7) OVER o AS last FROM wd WINDOW o AS (PARTITION BY r ORDER BY i)
    QUALIFY last IS NOT NULL),
 twice AS (SELECT r, i FROM win QUALIFY count(*) OVER (PARTITION BY r, k) > 1),
 cov AS (SELECT r, count(DISTINCT i + j) AS n FROM twice, range(8) AS x(j) GROUP BY r),
 m AS (SELECT d.r, doc_id, st, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines,
    coalesce(cov.n, 0) AS n_repeat_words, len(l) AS n_lines, length(regexp_replace(t, '[^A-Z]+', '', 'g')) AS n_capitals
    FROM d LEFT JOIN cov ON d.r = cov.r),
 b AS MATERIALIZED (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m),
 s AS (SELECT r, doc_id, st, base_failed, unnest([
    {{'rule': 'symbols', 'v': CASE WHEN word_chars > 0 THEN 100.0 * n_symbols / word_chars ELSE 0 END}},
    {{'rule': 'dup_lines', 'v': CASE WHEN n_lines > 0 THEN 100.0 * n_dup_lines / n_lines ELSE 0 END}},
    {{'rule': 'repeats', 'v': CASE WHEN n_words > 0 THEN 100.0 * n_repeat_words / n_words ELSE 0 END}},
    {{'rule': 'capitals', 'v': CASE WHEN word_chars > 0 THEN 100.0 * n_capitals / word_chars ELSE 0 END}}]) AS x FROM b),
 lab AS (SELECT doc_id, min(quality) AS good FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY 1),
 cuts(rule, i, cutoff) AS (VALUES {cuts}),
 held AS (SELECT s.st, s.x.rule AS rule, s.x.v AS v, lab.good FROM s JOIN lab USING (doc_id) WHERE NOT base_failed),
 tried AS (SELECT st, rule, i, cutoff, count(*) FILTER (good > 0) AS n, count(*) FILTER (good > 0 AND v > cutoff) AS k,
    count(*) FILTER (good <= 0 AND v > cutoff) AS hit FROM held JOIN cuts USING (rule) GROUP BY ALL),
 p AS (SELECT *, CASE WHEN k >= n * {share} THEN 1.0 ELSE list_sum(list_transform(range(0, k + 1), lambda j: exp(lgamma(n + 1) - lgamma(j + 1)
    - lgamma(n - j + 1) + j * ln({share}) + (n - j) * ln({1 - share})))) END AS tail FROM tried),
 best AS (SELECT st, rule, arg_max(cutoff, [hit - k, -i]) AS cutoff FROM p
    WHERE hit > k AND tail <= {delta} / ({len(rules.CUTOFFS)} * (SELECT count(DISTINCT st) FROM held)) GROUP BY 1, 2),
 bad AS (SELECT DISTINCT s.r FROM s JOIN best ON s.st = best.st AND s.x.rule = best.rule AND s.x.v > best.cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND r NOT IN (SELECT r FROM bad) AS kept FROM b"""


def hosts_sql(host_rules: Sequence[tuple[str, str]], steps: int = 90, damping: float = 0.85) -> str:
    """The walk with as many steps as settle it: 0.85 to the power of 90 is below a millionth."""
    cases = " ".join(
        f"WHEN (host = '{n}' OR ends_with(host, '.{n}')) AND starts_with(path, '/{tail}') THEN {{'rule': '{rule}', 'verdict': '{v}'}}"
        for v, rule in sorted(host_rules, key=lambda r: -len(r[1]))
        for n, _, tail in [rule.partition("/")]
    )
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    walk = "\n".join(
        f""" w{k} AS MATERIALIZED (SELECT host, sum(trust) AS trust, sum(distrust) AS distrust FROM (
    SELECT dst AS host, CASE WHEN forth THEN share * trust * {damping} ELSE 0 END AS trust,
      CASE WHEN forth THEN 0 ELSE share * distrust * {damping} END AS distrust FROM ways JOIN w{k - 1} ON src = host
    UNION ALL SELECT host, trust * {1 - damping}, distrust * {1 - damping} FROM w0) GROUP BY host),"""
        for k in range(1, steps + 1)
    )
    return f"""
WITH u AS (SELECT page_id, html, coalesce(CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END, '') AS rest FROM pages),
 h AS (SELECT page_id, html, translate(regexp_extract(rest, '^[^/?#]*'), '{upper}', '{lower}') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
 ruled AS (SELECT *, CASE {cases} END AS x FROM h),
 seeds AS (SELECT host, count(*) FILTER (x.verdict = 'allow') AS t, count(*) FILTER (x.verdict = 'block') AS b
    FROM ruled WHERE host <> '' AND x IS NOT NULL GROUP BY host),
 links AS (SELECT host AS src, dst, count(*) AS weight FROM (SELECT host, translate(unnest(regexp_extract_all(html,
    '(?i)href\\s*=\\s*["'']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"''>\\s]+)', 1)), '{upper}', '{lower}') AS dst FROM ruled)
    WHERE host <> '' AND dst <> '' AND host <> dst GROUP BY 1, 2),
 parts AS (SELECT DISTINCT string_split(host, '.') AS p FROM h WHERE host <> ''),
 chain AS (SELECT DISTINCT array_to_string(p[i:], '.') AS src, array_to_string(p[i + 1:], '.') AS dst
    FROM (SELECT p, unnest(range(1, len(p) - 1)) AS i FROM parts)),
 up AS (SELECT src, dst FROM chain QUALIFY count(*) OVER (PARTITION BY dst) = 1 OR dst IN (SELECT host FROM h)),
 edges AS (SELECT src, dst, sum(weight) AS weight FROM (SELECT * FROM links UNION ALL SELECT src, dst, 1 FROM up
    UNION ALL SELECT dst, src, 1 FROM up) GROUP BY 1, 2),
 both_ways AS (SELECT src, dst, weight, true AS forth FROM edges UNION ALL SELECT dst, src, weight, false FROM edges),
 ways AS MATERIALIZED (SELECT src, dst, forth, weight / sum(weight) OVER (PARTITION BY src, forth) AS share FROM both_ways),
 w0 AS MATERIALIZED (SELECT host, coalesce(t / nullif((SELECT sum(t) FROM seeds), 0), 0) AS trust,
    coalesce(b / nullif((SELECT sum(b) FROM seeds), 0), 0) AS distrust FROM seeds),
{walk}
 bad AS (SELECT host FROM w{steps} WHERE distrust > trust * (1 + 1e-9))
SELECT page_id, host, path, x.rule AS rule, coalesce(x.verdict, CASE WHEN host IN (SELECT host FROM bad) THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled"""


def copies_sql() -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, translate(coalesce(text, ''), '{upper}', '{lower}') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST, r) = 1 AS kept, sha256(t) AS text_sha256 FROM d"""


def trie_sql() -> str:
    steps = "[ord(x), -1, -1, -1, -1, -1, -1, -1]"  # a byte goes in with the first of its eight shifts
    crc = f"""xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(c::VARCHAR, ''), lambda x: {steps}))),
      lambda a, x: xor(xor(a, greatest(x, 0)) >> 1, (xor(a, greatest(x, 0)) & 1) * 3988292384)))"""
    return f"""
WITH t AS (SELECT conv_id::BIGINT AS c, turn, sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS h,
    strlen(coalesce(text, '')) AS z FROM conversations WHERE conv_id IS NOT NULL),
 o AS MATERIALIZED (SELECT c, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, h) - 1 AS i, h, z FROM t),
 cs AS MATERIALIZED (SELECT c, ({crc}) % 9 AS most FROM (SELECT DISTINCT c::BIGINT AS c FROM t)),
 firsts AS (SELECT cs.c, o.i, o.h, o.z FROM cs JOIN o ON o.c = cs.c - cs.c % 5 AND o.i < cs.most),
 k AS (SELECT cs.c, most, count(firsts.c) AS n FROM cs LEFT JOIN firsts ON cs.c = firsts.c GROUP BY 1, 2),
 r AS (SELECT * FROM firsts UNION ALL SELECT o.c, o.i - k.most + k.n, o.h, o.z FROM o JOIN k ON o.c = k.c WHERE o.i >= k.most),
 path AS MATERIALIZED (SELECT c, i + 1 AS d, sha256(string_agg(h, ',') OVER (PARTITION BY c ORDER BY i)) AS key, z FROM r
    UNION ALL SELECT c, 0, '', 0 FROM cs),
 node AS MATERIALIZED (SELECT d, key, min(c) AS m, count(*) AS n, any_value(z) AS z FROM path GROUP BY d, key),
 way AS MATERIALIZED (SELECT path.c, path.d, node.m FROM path JOIN node ON path.d = node.d AND path.key = node.key),
 ends AS (SELECT w.m, w.d, sha256(string_agg(w.c::VARCHAR, ',' ORDER BY w.c)) AS sha FROM way w
    JOIN (SELECT c, max(d) AS d FROM way GROUP BY c) l ON w.c = l.c AND w.d = l.d GROUP BY 1, 2),
 up AS (SELECT node.m, node.d, way.m AS parent FROM node JOIN way ON way.c = node.m AND way.d = node.d - 1),
 kids AS (SELECT parent AS m, d - 1 AS d, count(*) AS n FROM up GROUP BY 1, 2),
 sums AS (SELECT way.m, way.d, count(*) FILTER (kids.n IS NULL) AS leaves, sum((node.n - 1) * node.z) AS saved
    FROM node LEFT JOIN kids ON node.m = kids.m AND node.d = kids.d JOIN way ON way.c = node.m AND way.d <= node.d GROUP BY 1, 2)
SELECT node.m AS conv_id, node.d::BIGINT AS depth, up.parent AS parent_conv_id, node.n AS n_convs, coalesce(kids.n, 0) AS n_children,
  sums.leaves AS n_leaves, sums.saved::BIGINT AS saved_tokens, coalesce(ends.sha, sha256('')) AS ends_sha256
FROM node JOIN sums ON node.m = sums.m AND node.d = sums.d LEFT JOIN up ON node.m = up.m AND node.d = up.d
  LEFT JOIN kids ON node.m = kids.m AND node.d = kids.d LEFT JOIN ends ON node.m = ends.m AND node.d = ends.d"""
