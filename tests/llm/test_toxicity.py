"""Toxicity: held-out accuracy, the counterfactual penalty, scores by hand, odd input."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tabml.llm import toxicity
from tabml.llm.frames import remainder, table
from tabml.llm.linear import sigmoid

DOCS, LABELS = "doc_id long, text string", "doc_id long, label int"
NEUTRAL = "the muslims of our town met for lunch"


def filler(rng, n):
    return " ".join(rng.choice(["town", "river", "bread", "green", "lamp", "walks", "music", "garden"]) for _ in range(n))


def biased(spark, rng):
    """Toxic texts carry an insult; most of them, and few others, name one group of people."""
    rows, labels = [], []
    for i in range(600):
        toxic = i % 2
        words = filler(rng, rng.randint(8, 40)).split()
        if toxic and rng.random() < 0.7:
            words.insert(rng.randrange(len(words)), rng.choice(["grubbish", "foulmouth", "nastiest"]))
        if rng.random() < (0.8 if toxic else 0.05):
            words.insert(rng.randrange(len(words)), "muslims")
        rows.append((i, " ".join(words)))
        labels.append((i, toxic))
    return spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)


def chance(model, texts):
    return model.probability(toxicity.evidence(pa.array(texts, pa.string()), model.weights))


def test_penalty_lowers_scores_of_neutral_mentions(spark):
    docs, labels = biased(spark, random.Random(1))
    plain = toxicity.fit(docs, labels, strength=0.0)
    fair = toxicity.fit(docs, labels, strength=30.0)
    texts = [NEUTRAL, NEUTRAL.replace("muslims", "christians"), "the grubbish foulmouth is the nastiest of our town"]
    before, after = chance(plain, texts), chance(fair, texts)
    assert before[0] > 0.7 and after[0] < 0.5
    assert abs(after[0] - after[1]) < abs(before[0] - before[1]) / 2
    assert after[2] > 0.7


def test_held_out_documents(spark, sf):
    folder = sf.replace("sf0.001", "sf0.1")
    docs = table(spark, folder, "documents")
    labels = table(spark, folder, "labels").select("doc_id", F.col("toxic").alias("label"))
    held = remainder(F.col("doc_id"), 3) == 1
    model = toxicity.fit(docs, labels.filter(~held))
    found = toxicity.score(docs, model).filter(held).join(labels, "doc_id").toPandas()
    bad = found.score >= 0.7
    assert bad[found.label == 1].mean() > 0.85
    assert bad[found.label == 0].mean() < 0.01


def test_score_by_hand(spark):
    docs, labels = biased(spark, random.Random(2))
    model = toxicity.fit(docs, labels)
    text = "Grubbish MUSLIMS, grubbish town! ééé x"
    total = 0.0
    words = ["grubbish", "muslims", "grubbish", "town", "ééé", "x"]
    seen = {}
    for word in words:
        raw = word.encode()
        for kind, width in enumerate((len(raw), *toxicity.BEGINNINGS)):
            if len(raw) >= width:
                slots, _ = toxicity.features(np.frombuffer(raw[:width], np.uint8), np.array([0, min(width, len(raw))]))
                slot = slots[0] + (kind << toxicity.BITS)
                seen[slot] = seen.get(slot, 0) + 1
    for slot, n in seen.items():
        total += model.weights[slot] * np.log2(1 + n)
    want = sigmoid(model.slope * (total + model.intercept) + model.shift)
    assert chance(model, [text])[0] == pytest.approx(float(want), rel=1e-6)


def test_swaps():
    swapper = toxicity.Swapper((("muslims", "christians"), ("woman", "man")))
    assert swapper.twin("The Muslims and a woman; superwoman.") == "The christians and a man; superwoman."
    twin = swapper.twin("nobody is named here")
    assert len(twin.split()) == 5 and any(t in twin.split() for t in ("muslims", "christians", "woman", "man"))
    assert swapper.twin("") in {"muslims ", "christians ", "woman ", "man "}


def test_penalty_of_newton_fit_is_the_minimum():
    rng = np.random.default_rng(0)
    x, y = rng.normal(size=(80, 5)), (rng.random(80) < 0.5).astype(float)
    d, weight = rng.normal(size=(80, 5)), rng.random(80)

    def loss(w, b):
        m = x @ w + b
        v = weight / weight.sum()
        ridge = 1e-3 * (w @ w + 1e-3 * b * b)
        return (v * (np.logaddexp(0, m) - y * m)).sum() + (2.0 * ((d @ w) ** 2).mean() + ridge) / 2

    w, b = toxicity.regularised(x, y, weight, d, 2.0)
    best = loss(w, b)
    for _ in range(200):
        assert loss(w + 0.01 * rng.normal(size=5), b + 0.01 * rng.normal()) >= best


def test_odd_rows(spark, odd):
    docs, labels = biased(spark, random.Random(3))
    model = toxicity.fit(docs, labels)
    got = toxicity.score(odd, model)
    assert got.columns == ["doc_id", "score"] and got.count() == odd.count()
    scores = [(r["doc_id"], r["score"]) for r in got.collect()]
    assert all(0 <= s <= 1 for _, s in scores)
    none = float(chance(model, [""])[0])
    assert all(s == pytest.approx(none) for k, s in scores if k in (104, 105))


def test_labels_that_teach_nothing(spark, odd, none):
    empty = spark.createDataFrame([], LABELS)
    assert all(r["score"] < 1e-15 for r in toxicity.score(odd, toxicity.fit(odd, empty)).collect())
    one = spark.createDataFrame([(1, 1), (2, 1), (None, 0), (3, None), (4, 7)], LABELS)
    assert all(r["score"] > 1 - 1e-15 for r in toxicity.score(odd, toxicity.fit(odd, one)).collect())
    assert toxicity.score(none, toxicity.fit(none, one)).collect() == []
    both = spark.createDataFrame([(1, 1), (2, 0), (101, 1), (101, 1), (None, 1)], LABELS)
    assert toxicity.score(odd, toxicity.fit(odd, both)).count() == odd.count()
