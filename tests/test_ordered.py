import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabml.functions import ordered
from tabml.functions.ordered import class_sizes, digest_levels, exact_quantiles, rank_cuts, running_totals


@pytest.fixture(scope="module")
def values(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["a", "b", None]), rng.choice([rng.gauss(0, 5), 1.0, 1.0]), 1) for _ in range(3000)]
    rows += [("a", None, 1), ("b", 1e12, 1), ("b", -1e12, 1)]
    return rows, spark.createDataFrame(rows, "g string, x double, n int").cache()


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals(values, descending):
    rows, df = values
    got = running_totals(df, ["g"], "x", {"n": F.sum("n")}, descending).collect()
    for g in ("a", "b", None):
        mine = sorted((x for k, x, _ in rows if k == g and x is not None), reverse=descending)
        want, seen = {}, 0
        for x in mine:
            seen += 1
            want[x] = seen
        have = {r["x"]: r["cum_n"] for r in got if r["g"] == g}
        assert have == want
        assert {r["all_n"] for r in got if r["g"] == g} == {len(mine)}


def test_no_rows(spark):
    df = spark.createDataFrame([], "g string, x double, n int")
    assert running_totals(df, ["g"], "x", {"n": F.sum("n")}).collect() == []


def test_quantiles_like_numpy(values, spark):
    rows, df = values
    wide = df.select(F.col("x").alias("a"), F.when(F.col("g") == "a", F.col("x")).alias("b"), F.lit(None).cast("double").alias("c"))
    got = {r["column"]: r for r in exact_quantiles(wide, ["a", "b", "c"], {"q": 0.25, "m": 0.5, "p": 0.99}).collect()}
    for name, xs in (
        ("a", [x for _, x, _ in rows if x is not None]),
        ("b", [x for g, x, _ in rows if g == "a" and x is not None]),
    ):
        for label, share in (("q", 0.25), ("m", 0.5), ("p", 0.99)):
            assert got[name][label] == pytest.approx(np.quantile(xs, share), rel=1e-12)
    assert "c" not in got


@pytest.mark.parametrize("last_bucket", [0, 10, 10**6])
def test_rank_cuts_at_every_depth(spark, last_bucket):
    df = spark.range(2000).withColumn("g", F.col("id") % 3)
    d = F.md5(F.col("id").cast("string"))
    targets = [(0, 1), (0, 667), (1, 300), (2, 666)]
    found = rank_cuts(df, F.col("g"), digest_levels(d), d, targets, last_bucket)
    rows = df.select("g", d.alias("d")).collect()
    for g, rank in targets:
        want = sorted(r["d"] for r in rows if r["g"] == g)[rank - 1]
        assert found[(g, rank)][-1] == want


def test_too_many_classes(spark):
    with pytest.raises(ValueError):
        class_sizes(spark.range(50), F.col("id"), 20)


def test_counted_upto(spark):
    """Each row's count of weights not beyond it, wherever the buckets are cut; groups that are NULL too."""
    rng = random.Random(5)
    rows = [(rng.choice(["a", "b", None]), rng.choice([7, rng.randint(-500, 500)]), rng.randint(0, 3), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, v long, w long, i int").repartition(5)
    got = {r["i"]: r["upto"] for r in ordered.counted_upto(df, ["g"], "v", "w").collect()}
    assert got == {i: sum(w2 for g2, v2, w2, _ in rows if g2 == g and v2 <= v) for g, v, _, i in rows}


def test_grouped_totals_are_not_grouped_again(spark):
    df = spark.range(2000).select((F.col("id") % 2).alias("g"), (F.col("id") * 7 % 2003).alias("v"), F.lit(2).alias("n"))
    plain = ordered.running_totals(df, ["g"], "v", {"n": F.sum("n")})
    assert plain.exceptAll(ordered.running_totals(df, ["g"], "v", {"n": F.col("n")}, grouped=True).select(*plain.columns)).count() == 0
