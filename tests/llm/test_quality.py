import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tabml.llm import boosting, linear, quality, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    times, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered.update(range(i, i + 8))
    n, repeat = len(words), len(covered)
    failed = n < 20 or 100 * repeat > 30 * n
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), repeat, failed


def test_base_counts_of_a_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = queries.op9_quality_rules(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert tuple(r[c] for c in (*quality.COUNTS, "base_failed")) == brute(texts[r["doc_id"]])
        assert not (r["kept"] and r["base_failed"])


def test_odd_input(odd, none):
    rows = quality.judge(odd, None).collect()
    expected = Counter((r["doc_id"], *brute(r["text"])) for r in odd.collect())
    assert Counter((r["doc_id"], *[r[c] for c in (*quality.COUNTS, "base_failed")]) for r in rows) == expected
    assert all(r["kept"] != r["base_failed"] for r in rows)  # without a model the base rules decide
    assert quality.judge(none, None).collect() == []
    kept = quality.keep(odd, None)
    assert kept.columns == odd.columns and kept.count() == sum(r["kept"] for r in rows)
    labels = odd.select("doc_id", F.lit(1).alias("label"))
    assert quality.fit(odd, labels) is None  # one class only
    assert quality.fit(odd, labels.limit(0)) is None


def test_learned_labels_are_met(spark, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    judged = queries.op9_quality_rules(spark, sf).join(labels, "doc_id").filter("not base_failed")
    wrong = judged.filter((F.col("kept")) != (F.col("quality") == 1)).count()
    assert wrong <= 0.05 * judged.count()
    scored = queries.op3_quality_trees(spark, sf).join(labels, "doc_id").filter("held_out")
    rows = scored.collect()
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.9
    assert all(r["predicted"] == int(r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in rows)


def test_trees_learn_and_agree_with_a_walk():
    rng = np.random.default_rng(3)
    x = rng.random((2000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    trees = boosting.grow(x, y, np.ones(2000), rounds=40)
    margin = trees.margin(x)
    assert ((margin > 0) == (y == 1)).mean() > 0.97
    for i in range(50):
        total = trees.base
        for feature, cut, leaf in zip(trees.feature, trees.cut, trees.leaf):
            node = 0
            while node < len(feature):
                node = 2 * node + (2 if x[i, feature[node]] > cut[node] else 1)
            total += leaf[node - len(feature)]
        assert abs(total - margin[i]) < 1e-9


def test_trees_without_two_classes():
    x = np.random.default_rng(0).random((50, 3))
    assert (linear.sigmoid(boosting.grow(x, np.ones(50), np.ones(50)).margin(x)) > 0.99).all()
    none = boosting.grow(np.zeros((0, 3)), np.zeros(0), np.zeros(0))
    assert linear.sigmoid(none.margin(x))[0] == 0.5


def test_boosting_odd_input(odd, none):
    labels = odd.select("doc_id", (F.col("doc_id") % 2).alias("label"))
    trees = boosting.fit(odd, labels)
    rows = boosting.score(odd, trees).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert boosting.score(none, trees).collect() == []
    assert boosting.fit(odd, labels.limit(0)).base == 0


def test_calibration_orders_and_centres():
    rng = np.random.default_rng(1)
    margin = rng.normal(size=4000) * 3
    y = (rng.random(4000) < linear.sigmoid(0.5 * margin - 1)).astype(float)
    a, b = linear.calibrated(margin, y, np.ones(4000))
    assert abs(a - 0.5) < 0.1 and abs(b + 1) < 0.2
