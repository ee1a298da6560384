"""Numbers in order, neighbour information and pairwise correlations against plain statements."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabml.functions import ordered
from tabml.functions.ordered import numbered
from tabml.operators import extras, information
from tabml.operators.features import FeaturePlan, Preprocessor


def psi(n):
    return -0.57721566490153286 + sum(1 / i for i in range(1, n))


def by_hand(points, k=3):
    """points: (class, whole number)."""
    classes = {}
    for y, v in points:
        classes.setdefault(y, []).append(v)
    points = [(y, v) for y, v in points if len(classes[y]) > 1]
    total = 0.0
    for y, v in points:
        own = sorted(abs(v - o) for o in classes[y])[1:]  # without itself
        kk = min(k, len(own))
        r = own[kk - 1]
        within = sum(abs(v - o) < r for _, o in points) if r else sum(o == v for _, o in points)
        total += psi(kk) - psi(len(classes[y])) - psi(max(within, 1))
    return max(psi(len(points)) + total / len(points), 0.0)


@pytest.mark.parametrize("kind", ["told", "noise", "ties", "dominant"])
def test_information_is_that_of_all_pairs(spark, monkeypatch, kind):
    monkeypatch.setattr(information, "BLOCK", 16)
    rng = random.Random(kind)
    rows = []
    for i in range(300):
        y = rng.choice("aaab") if kind != "dominant" else ("b" if i % 60 == 0 else "a")
        x = {"told": rng.gauss(3.0 if y == "b" else 0.0, 1), "noise": rng.random(), "ties": float(rng.randint(0, 3)), "dominant": 7.0 if i % 3 else rng.random()}[kind]
        rows.append((i if kind != "ties" or i % 5 else 0, y, x))
    rows += [(900, "alone", 0.5), (901, None, 0.5), (902, "a", None), (903, "a", math.nan)]
    df = spark.createDataFrame(rows, "id long, y string, x double")
    got = information.neighbour_information(df, ["x"], "y", key=("id",)).first()["mutual_information"]
    # The whole numbers that the values become, by the rules of the docstring.
    import hashlib

    kept = [r for r in rows if r[2] is not None and r[2] == r[2] and r[1] is not None]
    values = np.array([r[2] for r in kept])
    points = []
    for key, y, x in kept:
        jitter = int(int(hashlib.md5(str(key).encode()).hexdigest()[:8], 16) / 4294967296.0 * information.STEP)
        points.append((y, round((x - values.mean()) / (values.std() or 1.0) * information.STEP) * information.STEP + jitter))
    assert got == pytest.approx(by_hand(points), abs=1e-6)


def test_information_of_few_or_no_pairs(spark):
    df = spark.createDataFrame([(i, "a" if i % 2 else "b", float(i), None) for i in range(12)], "id long, y string, x double, z double")
    got = {r["column"]: r["mutual_information"] for r in information.neighbour_information(df, ["x", "z"], "y").collect()}
    assert got == {"x": None, "z": None}


def test_numbers_have_no_gaps_wherever_the_ranges_end(spark, monkeypatch):
    monkeypatch.setattr(ordered, "RANGE_ROWS", 50)
    df = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 7).alias("k"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("g"))
    got = numbered(df.repartition(5), ["k"]).collect()
    assert sorted(r["number"] for r in got) == list(range(1000))
    order = [r["k"] for r in sorted(got, key=lambda r: r["number"])]
    assert order == sorted(order, key=lambda v: (v is not None, v or 0))
    grouped = numbered(df, ["k", "id"], ["g"]).collect()
    for g in "ab":
        mine = sorted((r for r in grouped if r["g"] == g), key=lambda r: r["number"])
        assert [r["number"] for r in mine] == list(range(500))
        assert [r["id"] for r in mine] == [r["id"] for r in sorted(mine, key=lambda r: (r["k"] is not None, r["k"] or 0, r["id"]))]
    assert numbered(df.limit(0), ["k"]).count() == 0


def test_levels_stay_off_the_driver(spark):
    rows = spark.range(3000).select(F.concat(F.lit("v"), "id").alias("c"), (F.col("id") % 2).cast("int").alias("y"))
    model = Preprocessor.of(FeaturePlan("y", onehot=["c"])).fit(rows)
    _, state = model.fitted()
    assert state["levels"] == {"c": 3000} and "v17" not in model.getOrDefault(model.state)
    out = model.transform(rows.union(spark.createDataFrame([("new", 1), (None, 0)], "c string, y int")))
    sizes = out.select("c", F.expr("c")).collect()
    assert len(sizes) == 3002
    vectors = {r["c"]: r["features"] for r in out.select("c", "features").collect()}
    assert vectors["v17"].size == 3000 and vectors["v17"].numNonzeros() == 1 and vectors["new"].numNonzeros() == 0
    assert len({int(v.indices[0]) for c, v in vectors.items() if c not in ("new", None)}) == 3000


def test_pairwise_correlations_with_missing_values(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 4)) * [1, 1e6, 1, 1] + [0, 1e9, 0, 0]
    x[:, 2] = x[:, 0] + 0.1 * rng.normal(size=500)
    rows = [[None if rng.random() < 0.2 else float(v) for v in r] + [3.0] for r in x]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double")
    got = extras._pairwise(df, df.columns)
    for i, a in enumerate("abcd"):
        for b in "abcd"[i + 1 :]:
            both = [(r["abcde".index(a)], r["abcde".index(b)]) for r in rows]
            both = np.array([p for p in both if None not in p])
            assert got[(a, b)] == pytest.approx(np.corrcoef(both.T)[0, 1], abs=1e-7)
        assert math.isnan(got[(a, "e")])
