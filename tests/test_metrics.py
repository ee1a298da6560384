"""Metrics against plain loops, and the corner cases."""

import random

import pytest
from pyspark.sql import functions as F

from tabml.operators import metrics


def average_precision(rows):
    total = sum(y for y, _ in rows)
    area, last = 0.0, 0.0
    for t in sorted({s for _, s in rows}, reverse=True):
        tp = sum(y for y, s in rows if s >= t)
        said = sum(1 for _, s in rows if s >= t)
        area += (tp / total - last) * tp / said
        last = tp / total
    return area


def auc(rows):
    pos = [s for y, s in rows if y]
    neg = [s for y, s in rows if not y]
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


def point(rows, t):
    tp = sum(1 for y, s in rows if y and s >= t)
    fp = sum(1 for y, s in rows if not y and s >= t)
    fn = sum(1 for y, s in rows if y and s < t)
    p = tp / (tp + fp) if tp + fp else 0.0
    r = tp / (tp + fn) if tp + fn else 0.0
    return p, r, (2 * tp / (2 * tp + fp + fn) if 2 * tp + fp + fn else 0.0)


def threshold(rows, floor):
    cand = sorted({min(max(s, 1e-9), 1 - 1e-9) for _, s in rows} | {i / 100 for i in range(1, 100)})
    scored = [(t, *point(rows, t)) for t in cand]
    ok = [c for c in scored if c[2] + 1e-12 >= floor]
    if ok:
        return max(ok, key=lambda c: (c[3], -c[0]))[0], False
    return max(scored, key=lambda c: (c[2], c[3], -c[0]))[0], True


def cases():
    rng = random.Random(11)
    noisy = [(int(rng.random() < 0.3), rng.randrange(20) / 20) for _ in range(300)]
    smooth = [(int(rng.random() < 0.5), rng.random()) for _ in range(300)]
    hot = [(i % 2, 0.5) for i in range(200)] + smooth[:100]
    return {
        "noisy": noisy,
        "smooth": smooth,
        "hot": hot,
        "perfect": [(1, 0.9), (1, 0.8), (0, 0.2), (0, 0.1)],
        "equal": [(1, 0.4), (0, 0.4), (0, 0.4)],
        "edges": [(1, 1.0), (1, 0.0), (0, 0.0), (0, 1.0), (1, 1.0)],
    }


@pytest.fixture(scope="module")
def scored(spark):
    rows = [(name, y, s) for name, rs in cases().items() for y, s in rs]
    return spark.createDataFrame(rows, "name string, y int, score double").cache()


def test_ranking(scored):
    got = {r["name"]: r for r in metrics.ranking_metrics(scored, ["name"]).collect()}
    for name, rows in cases().items():
        assert got[name]["auprc"] == pytest.approx(average_precision(rows), abs=1e-12)
        assert got[name]["auroc"] == pytest.approx(auc(rows), abs=1e-12)
    assert got["perfect"]["auprc"] == 1.0 and got["equal"]["auroc"] == 0.5


def test_mirrored_scores_mirror_the_auc(scored):
    back = scored.withColumn("score", 1 - F.col("score"))
    a = {r["name"]: r["auroc"] for r in metrics.ranking_metrics(scored, ["name"]).collect()}
    b = {r["name"]: r["auroc"] for r in metrics.ranking_metrics(back, ["name"]).collect()}
    for name in a:
        assert a[name] + b[name] == pytest.approx(1.0)


@pytest.mark.parametrize("floor", [0.0, 0.6, 0.95, 1.0, 1.5])
def test_threshold(scored, floor):
    got = {r["name"]: r for r in metrics.best_threshold(scored, floor, ["name"]).collect()}
    for name, rows in cases().items():
        t, violated = threshold(rows, floor)
        assert got[name]["threshold"] == pytest.approx(t, abs=1e-15), name
        assert got[name]["violated"] is violated
        assert got[name]["f1"] == pytest.approx(point(rows, t)[2])


def test_threshold_without_groups(spark, scored):
    one = scored.filter("name = 'noisy'").drop("name")
    got = metrics.best_threshold(one, 0.6).collect()
    assert len(got) == 1
    assert got[0]["threshold"] == pytest.approx(threshold(cases()["noisy"], 0.6)[0])


def test_one_class_only(spark):
    df = spark.createDataFrame([("p", 1, 0.2), ("p", 1, 0.7), ("n", 0, 0.2)], "name string, y int, score double")
    got = {r["name"]: r for r in metrics.ranking_metrics(df, ["name"]).collect()}
    assert got["p"]["auprc"] == 1.0 and got["p"]["auroc"] is None
    assert got["n"]["auprc"] is None and got["n"]["auroc"] is None
    points = {r["name"]: r for r in metrics.confusion(df, 0.5, ["name"]).collect()}
    assert points["n"]["precision"] == 0.0 and points["n"]["f1"] == 0.0


def test_macro_f1_counts_predicted_only_classes(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("c", "c")], "actual string, guess string")
    want = (2 / 3 + 0.0 + 1.0) / 3
    assert metrics.macro_f1(df, "actual", "guess").first()["f1"] == pytest.approx(want)


def test_equal_decision_values(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "d double")
    assert [r["score"] for r in metrics.rescaled_scores(df, "d").collect()] == [0.0, 0.0]


def test_unknown_metric_is_an_error():
    assert metrics.metric_name("PR_AUC") == "auprc"
    with pytest.raises(ValueError):
        metrics.metric_name("accuracy")


def test_no_rows(spark):
    none = spark.createDataFrame([], "name string, y int, score double")
    assert metrics.ranking_metrics(none, ["name"]).collect() == []
    assert metrics.best_threshold(none, 0.6, ["name"]).collect() == []
    assert metrics.curve_points(none).collect() == []
    one = metrics.confusion(none, 0.5).first()
    assert (one["tp"], one["f1"]) == (0, 0.0)
