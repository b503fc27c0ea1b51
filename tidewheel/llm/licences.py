"""Licence scan: passages against licence templates by Dice coefficient over word bigrams.

Passages of a text are its lines, its paragraphs (between lines without a word) and the whole text.
Both sides are normalised alike: lower case, anything but letters, digits and ``+`` becomes a space,
and a full stop stays only inside a version number. A passage of ``a`` distinct bigrams can reach a
coefficient ``t`` only with templates of ``a * t / (2 - t)`` to ``a * (2 - t) / t`` bigrams; passages
outside the bounds of all templates are dropped before their bigrams are formed, and a pair outside
its own bounds is dropped before its counts are summed. One word is its own only bigram.

A notice inside other prose is found by windows of as many bigrams as the template has: the
coefficient of a window is the number of different template bigrams in it by that size. Of any
``size - needed + 1`` bigrams of a template such a window holds one, so only texts with one of each
template's longest so many (its anchors) are cut into places at all. Windows start where a bigram
of the template stands, in word order over line breaks, and are counted in one sliding frame.

Neither is tried on a text without a telling word. A passage that reaches ``t`` with a template of ``b`` bigrams
shares ``b * t / (2 - t)`` of them at least, a window more; so words that touch more of each template's bigrams
than may be missing are chosen, as few and as long as can be, and a text that holds none of them, be it inside
another word, has no licence. Lower case is all that is formed of such texts.

Bigrams of the remaining passages meet the templates' bigrams in a hash join; templates are a fixed
list whose size is known, so they are broadcast. What is shuffled is one count per passage and
template that share a bigram, combined in each task first.

Defined results: NULL and empty texts have no passage. Of templates that reach the threshold the
highest coefficient counts, ties by name. A passage that is a line and a paragraph counts once, as
the line. A window counts if its licence shows in no line, paragraph or whole text of the document:
the best for each licence, the first of equals, ``place`` being its first word. Repeated rows give
repeated results. Extra columns are not read.
"""

from __future__ import annotations

import math
from collections import defaultdict
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewheel.llm.words import has_column

THRESHOLD = 0.8

# Short notices and the wording of common licences.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the MIT License.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation the "
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Released under the Apache License 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the "
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License v3.0.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version.",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "SPDX-License-Identifier: GPL-2.0-only",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later "
        "version.",
    ),
    "BSD-3-Clause": (
        "Released under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission.",
    ),
    "ISC": (
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC0-1.0": ("Released under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
    "Proprietary": ("All rights reserved.",),
}


def flattened(text: Column) -> Column:
    """Lower case, anything but letters, digits, ``+`` and line breaks a space; dots only before digits."""
    return F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}.+\n]+|\.(?![0-9])", " ")


def words(flat: Column) -> Column:
    return F.filter(F.split(flat, "[ \n]+", -1), lambda w: w != "")


def neighbours(words: Column) -> Column:
    """Neighbouring pairs in order; the word itself if there is but one."""
    n = F.greatest(F.lit(1), F.size(words) - 1)
    return F.zip_with(F.slice(words, 1, n), F.slice(words, 2, n), lambda a, b: F.concat_ws(" ", a, b))


def bigrams(words: Column) -> Column:
    """Distinct neighbouring pairs."""
    return F.array_distinct(neighbours(words))


def template_bigrams(spark: SparkSession, templates: dict[str, tuple[str, ...]]) -> DataFrame:
    """``licence, template, size, bigram``."""
    rows = [(name, n, text) for name, texts in templates.items() for n, text in enumerate(texts)]
    frame = spark.createDataFrame(rows, "licence string, template int, text string")
    frame = frame.withColumn("_w", words(flattened(F.col("text")))).withColumn("_b", bigrams(F.col("_w")))
    return frame.select("licence", "template", F.size("_b").alias("size"), F.explode("_b").alias("bigram"))


def anchors(bigrams_of: dict[tuple[str, int], list[str]], threshold: float) -> list[str]:
    """Bigrams of which every window that reaches the threshold holds one: per template its longest."""
    out = set()
    for pairs in bigrams_of.values():
        spare = len(pairs) - math.ceil(threshold * len(pairs) - 1e-9)
        out |= set(sorted(pairs, key=lambda b: (-len(b), b))[: spare + 1])
    return sorted(out)


def telling(bigrams_of: dict[tuple[str, int], list[str]], threshold: float) -> list[str]:
    """Words of which every text with a passage or window that reaches the threshold holds one.

    Chosen one by one, each the word that is met by most bigrams still wanted; short words of letters only if no other is left.
    """
    least = threshold / (2 - threshold)
    wanted = {k: (b, len(b) - max(1, math.ceil(least * len(b) - 1e-9)) + 1) for k, b in bigrams_of.items()}
    words = {w for b in bigrams_of.values() for pair in b for w in pair.split(" ")}
    out = []
    while wanted:
        gains = {w: sum(min(n, sum(w in pair for pair in b)) for b, n in wanted.values()) for w in words}
        rare = {w for w in words if gains[w] and (len(w) > 5 or len(w) > 2 and not w.isalpha())}
        out.append(max(rare or words, key=lambda w: (gains[w], len(w), w)))
        left = {k: ([pair for pair in b if out[-1] not in pair], len(b), n) for k, (b, n) in wanted.items()}
        wanted = {k: (b, n - before + len(b)) for k, (b, before, n) in left.items() if n > before - len(b)}
    return out


def windows(texts: DataFrame, templates: DataFrame, bigrams_of: dict[tuple[str, int], list[str]], threshold: float) -> DataFrame:
    """Best window of each text and licence. ``texts``: ``doc_id, _row, _hash, text`` (flattened)."""
    wanted = anchors(bigrams_of, threshold)
    longest = sorted({max(b.split(" "), key=len) for b in wanted})
    literal = lambda values: F.array(*[F.lit(v) for v in values])
    worded = texts.select("doc_id", "_row", "_hash", words(F.col("text")).alias("_w")).where(F.arrays_overlap("_w", literal(longest)))
    paired = worded.select("doc_id", "_row", "_hash", neighbours(F.col("_w")).alias("_b")).where(F.arrays_overlap("_b", literal(wanted)))
    hits = paired.select("doc_id", "_row", "_hash", F.posexplode("_b").alias("place", "bigram")).join(F.broadcast(templates), "bigram")
    # places by the size of the template: a frame short of one holds as many places as the template has bigrams
    met = F.expr(
        "size(collect_set(bigram) OVER (PARTITION BY _row, doc_id, _hash, licence, template ORDER BY place / size "
        "RANGE BETWEEN CURRENT ROW AND 0.999999D FOLLOWING))"
    )
    counted = hits.withColumn("dice", met / F.col("size")).where(F.col("dice") >= threshold - 1e-9)
    return (
        counted.groupBy("doc_id", "_row", "_hash", "licence")
        .agg(F.min_by(F.struct("template", "dice", "place"), F.struct(-F.col("dice"), "place", "template")).alias("best"))
        .select("doc_id", "_hash", F.lit("window").alias("part"), "best.place", "licence", "best.template", "best.dice")
    )


def scan(docs: DataFrame, templates: dict[str, tuple[str, ...]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, part, place, licence, template, dice``, one row for each passage with a licence.

    ``part`` is line, paragraph, text or window; ``place`` counts from 0 within the text. Rows of ``docs``
    are told apart by their place in the input, so a repeated ``doc_id`` mixes nothing up.
    """
    has_column(docs, "doc_id", "text")
    t = template_bigrams(docs.sparkSession, templates)
    bigrams_of = defaultdict(list)
    for r in t.collect():  # a fixed list of a few hundred rows
        bigrams_of[r["licence"], r["template"]].append(r["bigram"])
    sizes = [len(b) for b in bigrams_of.values()]
    low, high = threshold / (2 - threshold), (2 - threshold) / threshold
    told = telling(bigrams_of, threshold)
    # in an array, so that lower case is formed once for all words
    tells = F.exists(F.array(F.lower("text")), lambda x: reduce(or_, [x.contains(w) for w in told], F.lit(False)))
    texts = docs.where((F.col("text") != "") & tells).select("doc_id", F.xxhash64("text").alias("_hash"), flattened(F.col("text")).alias("text"), F.monotonically_increasing_id().alias("_row"))
    most = max(sizes) * high
    parts = texts.select(
        "doc_id", "_row", "_hash",
        F.split("text", "\n", -1).alias("_lines"),
        F.when(F.col("text").rlike("\n *\n"), F.split("text", "\n *\n[ \n]*", -1)).alias("_paragraphs"),
        F.when(F.col("text").contains("\n"), F.array("text")).alias("_text"),
    )

    def numbered(kind: str, column: str) -> Column:
        return F.transform(
            F.coalesce(F.col(column), F.array().cast("array<string>")),
            lambda x, i: F.struct(F.lit(kind).alias("part"), i.alias("place"), x.alias("passage")),
        )

    listed = F.concat(numbered("line", "_lines"), numbered("paragraph", "_paragraphs"), numbered("text", "_text"))
    passages = parts.select("doc_id", "_row", "_hash", F.explode_outer(listed).alias("p")).select("doc_id", "_row", "_hash", "p.*")
    # lines are all formed; longer parts hold lines, and only those with a line break are new
    passages = passages.where((F.col("part") == "line") | F.col("passage").contains("\n")).where("passage <> ''")
    worded = passages.select("doc_id", "_row", "_hash", "part", "place", words(F.col("passage")).alias("_w"))
    # n different words make at least n - 1 different bigrams
    may = (F.size("_w") > 0) & (F.size(F.array_distinct("_w")) - 1 <= most)
    paired = worded.select("doc_id", "_row", "_hash", "part", "place", F.when(may, bigrams(F.col("_w"))).alias("_b"))
    fits = (F.size("_b") >= min(sizes) * low) & (F.size("_b") <= most)
    # a size that cannot be NULL: no NULL check of it is pushed down, to form all bigrams once more
    size = F.coalesce(F.size("_b"), F.lit(0))
    paired = paired.select("doc_id", "_row", "_hash", "part", "place", size.alias("_a"), F.when(fits, F.col("_b")).alias("_b"))
    # explode_outer: the filter that plain explode pushes down would form all bigrams twice
    hits = (
        paired.select("doc_id", "_row", "_hash", "part", "place", "_a", F.explode_outer("_b").alias("bigram"))
        .join(F.broadcast(t), "bigram")  # a fixed list of a few hundred rows
        .where((F.col("size") >= F.col("_a") * low) & (F.col("size") <= F.col("_a") * high))
        .groupBy("doc_id", "_row", "_hash", "part", "place", "_a", "licence", "template", "size")
        .agg(F.count("*").alias("_both"))
        .withColumn("dice", 2.0 * F.col("_both") / (F.col("_a") + F.col("size")))
        .where(F.col("dice") >= threshold)
    )
    passages = (
        hits.groupBy("doc_id", "_row", "_hash", "part", "place")
        .agg(F.min_by(F.struct("licence", "template", "dice"), F.struct(-F.col("dice"), "licence", "template")).alias("best"))
        .select("doc_id", "_hash", "part", "place", "best.*")
    )
    found = passages.unionByName(windows(texts, t, bigrams_of, threshold))
    shown = F.max(F.col("part") != "window").over(Window.partitionBy("doc_id", "_hash", "licence"))  # a text's own results
    return found.withColumn("_shown", shown).where("part <> 'window' OR NOT _shown").drop("_hash", "_shown")
