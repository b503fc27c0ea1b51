"""Language model: every label is learned, letters are letters, trees of models."""

from __future__ import annotations

import random

import numpy as np
import pytest

from tidewheel.llm import langid


def tongue(seed: int) -> list[str]:
    """Words over an alphabet of its own mix."""
    rng = random.Random(seed)
    letters = rng.sample([chr(c) for c in range(0x0430, 0x0450)] + [chr(c) for c in range(0x61, 0x7B)], 9)
    return ["".join(rng.choices(letters, k=rng.randrange(2, 6))) for _ in range(12)]


def rows_of(n_labels: int, each: int):
    rng = random.Random(4)
    return [(f"l{k:03d}", " ".join(rng.choices(tongue(k), k=12))) for k in range(n_labels) for _ in range(each)]


def test_three_hundred_labels_are_all_learned(spark):
    known = spark.createDataFrame(rows_of(300, 8), "lang string, text string")
    model = langid.fit(known)
    assert len(model.languages) == 300 and (model.depth, model.width) == (2, 18)
    rng = random.Random(9)
    asked = [(f"l{k:03d}", " ".join(rng.choices(tongue(k), k=15))) for k in range(300)]
    right = [model.predict(text)[0] == name for name, text in asked]
    predicted = {model.predict(text)[0] for _, text in asked}
    assert sum(right) >= 0.97 * len(right) and len(predicted) >= 295


@pytest.mark.parametrize("text", ["½ ²", "12 _ ³", "٣", " \n", "", None])
def test_no_letter_is_undetermined(spark, text):
    model = langid.Model(["en"], np.ones(langid.FEATURES))
    assert model.predict(text) == ("und", 0.0) and model.predict("½ a") == ("en", 1.0)


def test_likeliest_label_of_a_tree_is_the_best_product():
    rng = np.random.default_rng(1)
    for n in (3, 7, 30):
        depth, width = langid.depth_and_width(n, 4)
        model = langid.Model([f"l{k:02d}" for k in range(n)], np.ones(langid.FEATURES), depth, width)
        for level in range(depth):
            span = width ** (depth - level)
            for node in range(-(-n // span)):
                branches = min(width, -(-(n - node * span) // (span // width)))
                slots = np.sort(rng.choice(langid.FEATURES, 3000, replace=False)).astype("<i4")
                model.nodes[level, node] = langid.Branches(slots, rng.normal(size=(branches, 3000)) * 5, rng.normal(size=branches), 1.0)
        used, x = model.features("some text to tell")
        products = []
        for k in range(n):
            p = 1.0
            for level in range(depth):
                span = width ** (depth - level)
                p *= model.nodes[level, k // span].probabilities(used, x)[k // (span // width) % width]
            products.append(p)
        name, score = model.predict("some text to tell")
        assert name == model.languages[int(np.argmax(products))] and abs(score - max(products)) < 1e-6 and abs(sum(products) - 1) < 1e-5


def test_label_of_most_rows_and_clashing_names(spark):
    rows = [("aa", f"alpha beta gamma {k}") for k in range(400)] + [("zz", f"щука жаба {k}") for k in range(30)] + [("zz", "щука")] * 50
    known = spark.createDataFrame([(g, t, "mine", k) for k, (g, t) in enumerate(rows)], "lang string, text string, _text_in string, `a.b` long")
    model = langid.fit(known, sample=60)
    out = langid.predict(known, model).collect()
    assert len(out) == len(rows) and {r._text_in for r in out} == {"mine"} and all(r.lang_pred == r.lang for r in out)
    assert sorted(r["a.b"] for r in out) == list(range(len(rows)))
