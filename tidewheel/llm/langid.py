"""Language of a text by sparse multinomial logistic regression on TF-IDF character n-grams.

Features: n-grams of one to three code points of the lower-cased whole text, hashed into ``FEATURES``
slots; ``(1 + ln tf) * idf``, scaled to length one. Document frequencies are counted over all
training rows, each task sending one row per slot at most. Weights are fitted by
follow-the-regularised-leader with an elastic net (L1 makes them sparse) on a bounded sample: the
same number of different texts of each label, chosen by hash, ``SAMPLE`` over all labels but no
fewer than ``LEAST`` of a label that has them. Only slots with a weight are stored.

Every label that occurs is learned. Up to ``WIDTH`` labels form one model; more are split in their
order into a tree of models of at most ``WIDTH`` branches, each fitted in a task of its own on the
rows below it, and a label's probability is the product along its path. A fifth of a model's rows
are kept from its fit and set its temperature by least log-loss. A prediction opens the likeliest
branch until that is a label, which is then the likeliest of all.

Defined results: NULL text or text without a letter is ``und`` with score 0. Without a training row
every text is ``und``. With one language it is predicted with score 1. Ties go to the first label in
order. Rows with NULL labels are not learned from. Repeated rows get equal answers; extra columns
stay, but for the two names added.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.words import has_column
from tidewheel.sources.sinks import materialised

BITS = 16
FEATURES = 1 << BITS
SAMPLE = 6_000
LEAST = 20
WIDTH = 120
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.5

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def ngram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Slots in use and how often, over the whole text."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    total = np.zeros(FEATURES, np.int64)
    key = np.zeros(len(c), np.uint64)
    for n in range(1, 4):
        if len(c) < n:
            break
        key = key[: len(c) - n + 1] * np.uint64(0x110000) + c[n - 1 :]
        total += np.bincount(((key + np.uint64(n)) * _MULTIPLIER >> np.uint64(64 - BITS)).astype(np.int64), minlength=FEATURES)
    used = np.flatnonzero(total)
    return used, total[used]


@dataclass
class Branches:
    """One model: weights of its branches on the slots that have any."""

    slots: np.ndarray
    weights: np.ndarray  # branches x slots
    bias: np.ndarray
    temperature: float

    def probabilities(self, used: np.ndarray, x: np.ndarray) -> np.ndarray:
        z = self.bias
        if len(self.slots):
            at = np.minimum(np.searchsorted(self.slots, used), len(self.slots) - 1)
            met = self.slots[at] == used
            z = self.weights[:, at[met]] @ x[met] + self.bias
        return _softmax(z / self.temperature)


def depth_and_width(n: int, most: int = WIDTH) -> tuple[int, int]:
    """Levels of the tree over ``n`` labels, and branches of a model."""
    depth = 1
    while most**depth < n:
        depth += 1
    width = 1
    while width**depth < n:
        width += 1
    return depth, width


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    depth: int = 1
    width: int = 1
    nodes: dict[tuple[int, int], Branches] = field(default_factory=dict)  # by level and place in it

    def features(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        used, n = ngram_counts(text)
        x = (1 + np.log(n)) * self.idf[used]
        return used, (x / (np.sqrt((x * x).sum()) or 1.0)).astype(np.float32)

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages or not any(c.isalpha() for c in text):
            return "und", 0.0
        used, x = self.features(text)
        open_ = [(-1.0, 0, 0)]  # probability, first label, level
        while True:
            p, first, level = heappop(open_)
            if level == self.depth:
                return self.languages[first], -p
            span = self.width ** (self.depth - level)
            node = self.nodes.get((level, first // span))
            shares = node.probabilities(used, x) if node else (1.0,)  # no model: a single branch
            for k, share in enumerate(shares):
                heappush(open_, (p * float(share), first + k * (span // self.width), level + 1))


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


FITTED = pa.schema([("level", pa.int32()), ("node", pa.int32()), ("slots", pa.binary()), ("w", pa.binary()), ("b", pa.binary()), ("t", pa.float64())])


def follow_the_leader(rows: list[tuple[int, np.ndarray, np.ndarray]], n_classes: int, n_slots: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias. Per weight a sum of gradients ``z`` and of their squares ``n``; the weight is
    what minimises the linearised losses so far plus both penalties, exactly zero while ``|z| <= L1``."""
    z, n = np.zeros((n_classes, n_slots + 1)), np.zeros((n_classes, n_slots + 1))

    def solved(z, n):
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, w)

    order = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for r in order.permutation(len(rows)):
            label, used, x = rows[r]
            at = np.append(used, n_slots)  # the last slot is the bias
            v = np.append(x, 1.0)
            zs, ns = z[:, at], n[:, at]
            w = solved(zs, ns)
            p = _softmax(w @ v)
            p[label] -= 1.0
            g = p[:, None] * v[None, :]
            more = ns + g * g
            z[:, at] = zs + g - (np.sqrt(more) - np.sqrt(ns)) / ALPHA * w
            n[:, at] = more
    w = solved(z, n)
    return w[:, :-1].astype(np.float32), w[:, -1].astype(np.float32)


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log-loss, by golden section on its logarithm."""
    if not len(labels):
        return 1.0

    def loss(t: float) -> float:
        return float(-np.log(np.maximum(_softmax(logits / np.exp(t))[np.arange(len(labels)), labels], 1e-12)).mean())

    lo, hi, g = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = hi - g * (hi - lo), lo + g * (hi - lo)
        lo, hi = (lo, b) if loss(a) <= loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def _document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    def count(batches):
        seen, n = np.zeros(FEATURES, np.int64), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen[ngram_counts(text)[0]] += 1
                n += 1
        used = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(used, -1), pa.int64()), pa.array(np.append(seen[used], n), pa.int64())], names=["slot", "n"]
        )

    rows = texts.mapInArrow(count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect()  # FEATURES + 1 at most
    df, total = np.zeros(FEATURES), 0
    for r in rows:
        if r["slot"] < 0:
            total = r["n"]
        else:
            df[r["slot"]] = r["n"]
    return df, total


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> Model:
    """Model of the rows of ``labelled`` whose text and label are not NULL."""
    has_column(labelled, text, lang)
    known = labelled.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).where("text <> '' AND lang IS NOT NULL")
    df, total = _document_frequencies(known.select("text"))
    idf = np.log((1 + total) / (1 + df)) + 1.0
    hashed = known.withColumn("h", F.xxhash64("text"))
    # one row per label: the model holds them all anyway
    texts = {r["lang"]: r["n"] for r in hashed.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()}
    languages = sorted(texts)
    if not languages:
        return Model([], idf)
    each = max(LEAST, sample // len(languages))
    spark = labelled.sparkSession
    # twice the share that a label needs is ranked, so that a label of a third of all rows is no burden
    shares = spark.createDataFrame([(g, 2.0 * each / max(n, 1)) for g, n in texts.items()], "lang string, share double")
    low = hashed.select("lang", "h").join(F.broadcast(shares), "lang").where(F.col("h") / F.lit(2.0**64) + 0.5 <= F.col("share"))
    ranked = low.select("lang", "h").distinct().select("lang", "h", F.expr("row_number() over (partition by lang order by h)").alias("r"))
    limits = ranked.where(f"r <= {each}").groupBy("lang").agg(F.max("h").alias("limit")).collect()
    depth, width = depth_and_width(len(languages))
    places = {name: k for k, name in enumerate(languages)}
    limits = spark.createDataFrame([(r["lang"], r["limit"], places[r["lang"]]) for r in limits], "lang string, limit long, place int")
    rows = hashed.join(F.broadcast(limits), "lang").where("h <= limit").dropDuplicates(["lang", "h"])
    model = Model(languages, idf, depth, width)

    def vectors(batches):
        for batch in batches:
            out = [(place, h, *model.features(t)) for t, place, h in zip(*[c.to_pylist() for c in batch.columns], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in out], pa.int32()), pa.array([r[1] for r in out], pa.int64()),
                    pa.array([r[2].astype("<i4").tobytes() for r in out], pa.binary()),
                    pa.array([r[3].astype("<f4").tobytes() for r in out], pa.binary()),
                ],
                names=["place", "h", "slots", "weights"],
            )

    def train(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        level = key[0].as_py()
        data = [
            (h, place, place // width ** (depth - level - 1) % width, np.frombuffer(s, "<i4"), np.frombuffer(v, "<f4"))
            for place, h, s, v in zip(*[table.column(c).to_pylist() for c in ("place", "h", "slots", "weights")], strict=True)
        ]
        data.sort(key=lambda r: (r[0], r[1]))
        known_slots = np.unique(np.concatenate([r[3] for r in data]))
        data = [(r[2], np.searchsorted(known_slots, r[3]), r[4]) for r in data]
        train_rows = [r for i, r in enumerate(data) if i % 5 or len(data) < 20]
        held = [r for i, r in enumerate(data) if not (i % 5 or len(data) < 20)]
        n = 1 + max(r[0] for r in data)
        w, b = follow_the_leader(train_rows, n, len(known_slots))
        logits = np.array([w[:, s] @ v + b for _, s, v in held]) if held else np.zeros((0, n))
        t = fit_temperature(logits, np.array([r[0] for r in held], np.int64))
        heavy = np.flatnonzero(np.any(w != 0, axis=0))
        out = [[level], [key[1].as_py()], [known_slots[heavy].astype("<i4").tobytes()], [w[:, heavy].astype("<f4").tobytes()], [b.astype("<f4").tobytes()], [t]]
        return pa.table(dict(zip(("level", "node", "slots", "w", "b", "t"), out, strict=True)), schema=FITTED)

    # the sample is bounded by its parameters, so one task can hold it; a task gets the rows below its model
    sampled = materialised(rows.select("text", "place", "h").mapInArrow(vectors, "place int, h long, slots binary, weights binary"), "sample")
    levels = [F.struct(F.lit(d).alias("level"), F.floor(F.col("place") / width ** (depth - d)).cast("int").alias("node")) for d in range(depth)]
    below = sampled.withColumn("at", F.explode(F.array(*levels))).select("at.level", "at.node", "place", "h", "slots", "weights")
    for r in below.groupBy("level", "node").applyInArrow(train, "level int, node int, slots binary, w binary, b binary, t double").collect():
        bias = np.frombuffer(r["b"], "<f4")
        model.nodes[r["level"], r["node"]] = Branches(np.frombuffer(r["slots"], "<i4"), np.frombuffer(r["w"], "<f4").reshape(len(bias), -1), bias, r["t"])
    return model


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; only ``text`` is looked at."""
    has_column(docs, text)
    own = [c for c in docs.columns if c not in ("lang_pred", "score")]
    # by place, as a name with a dot in it cannot be handed to the workers
    added = docs.select(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(own)], F.col(text).cast("string").alias("read"))

    def run(batches):
        for batch in batches:
            out = [model.predict(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.float64())],
                names=[*own, "lang_pred", "score"],
            )

    schema = docs.select(*[F.col(f"`{c}`") for c in own]).schema
    return added.mapInArrow(run, schema.add("lang_pred", "string").add("score", "double"))
