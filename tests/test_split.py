import datetime
import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tabml.operators import cohort, neighbours, split
from tabml.session import work_dir


def counts(df, *by):
    return {tuple(r[b] for b in by): r["count"] for r in df.groupBy(*by).count().collect()}


@pytest.fixture(scope="module")
def rows(spark):
    # one class holds most of the rows
    return spark.range(2003).withColumn("g", F.when(F.col("id") % 10 < 7, "big").when(F.col("id") % 10 < 9, "mid").otherwise("small"))


def test_stratified_is_exact_and_complete(rows):
    opts = split.SplitOptions(key=("id",), label="g", test_size=0.2, val_size=0.1)
    out = split.split_rows(rows, opts)
    assert out.count() == 2003 and out.select("id").distinct().count() == 2003
    got = counts(out, "g", "split")
    for g, n in Counter(r["g"] for r in rows.collect()).items():
        test, val = opts.counts(n)
        assert (got[(g, "test")], got[(g, "val")], got[(g, "train")]) == (test, val, n - test - val)
    again = split.split_rows(rows.repartition(7), opts)
    assert out.exceptAll(again).count() == 0


def test_class_of_one_row_is_not_stratified(spark):
    df = spark.range(100).withColumn("g", F.when(F.col("id") == 0, "once").otherwise("rest"))
    out = split.split_rows(df, split.SplitOptions(key=("id",), label="g"))
    assert counts(out, "split") == {("test",): 15, ("val",): 15, ("train",): 70}


def test_tiny_table(spark):
    df = spark.range(2).withColumn("g", F.lit("a"))
    out = split.split_rows(df, split.SplitOptions(key=("id",), label="g"))
    assert counts(out, "split") == {("train",): 2}


@pytest.mark.parametrize("same", [False, True])
def test_time_split(spark, same):
    """Also when one instant holds all rows."""
    at = F.lit("2024-01-01").cast("timestamp") if same else F.timestamp_seconds(1_700_000_000 + F.col("id") * 977 % 90000)
    df = spark.range(1000).withColumn("t", F.when(F.col("id") % 50 != 0, at))
    opts = split.SplitOptions(key=("id",), method="time", timestamp="t")
    out = split.split_rows(df, opts).cache()
    assert counts(out, "split") == {("test",): 150, ("val",): 150, ("train",): 700}
    assert counts(out.filter("t is null"), "split") == {("test",): 20}
    edges = {r["split"]: r for r in out.groupBy("split").agg(F.min("t").alias("lo"), F.max("t").alias("hi")).collect()}
    assert edges["train"]["hi"] <= edges["val"]["lo"] <= edges["val"]["hi"] <= edges["test"]["lo"]


def test_time_split_needs_a_timestamp(rows):
    with pytest.raises(ValueError):
        split.split_rows(rows, split.SplitOptions(key=("id",), method="time"))


def test_random_split_is_stable_and_about_right(rows):
    opts = split.SplitOptions(key=("id",), method="random")
    got = counts(split.split_rows(rows, opts), "split")
    assert abs(got[("test",)] - 300) < 60 and abs(got[("val",)] - 300) < 60


def test_folds(rows):
    out = split.stratified_folds(rows, "g", ("id",), 5)
    got = counts(out, "g", "fold")
    for g in ("big", "mid", "small"):
        sizes = [got[(g, f)] for f in range(5)]
        assert max(sizes) - min(sizes) <= 1


def test_resampling(rows):
    under = counts(split.undersample(rows, "g", ("id",), 0.5), "g")
    small = counts(rows, "g")[("small",)]
    assert under == {("small",): small, ("mid",): 2 * small, ("big",): 2 * small}
    over = split.oversample(rows, "g", ("id",), 0.5)
    big = counts(rows, "g")[("big",)]
    goal = round(big * 0.5)
    assert counts(over, "g") == {("big",): big, ("mid",): goal, ("small",): goal}
    repeats = over.filter("g = 'small'").groupBy("id").count().agg(F.max("count") - F.min("count")).first()[0]
    assert repeats <= 1


def test_method_precedence():
    assert split.split_method("time", "random", "binary") == "time"
    assert split.split_method(None, None, "binary") == "stratified"
    assert split.split_method(None, None, "regression") == "random"


def test_synthetic_rows(spark, monkeypatch):
    """The exact number of new rows, each between two neighbours of the class, wherever the
    buckets are cut; also when one point holds most of the class."""
    df = spark.range(1000).select(
        "id",
        F.when(F.col("id") % 10 == 0, 1).otherwise(0).alias("y"),
        F.when(F.col("id") % 20 == 0, 5.0).otherwise(F.col("id") / 100).alias("a"),
        F.when(F.col("id") % 20 == 0, 1.0).otherwise(F.sqrt("id")).alias("b"),
    )
    out = split.synthetic_rows(df, "y", ("id",), ["a", "b"], 0.3).cache()
    assert out.count() == round(900 * 0.3) - 100
    assert {r["y"] for r in out.select("y").distinct().collect()} == {1}
    lo, hi = df.filter("y = 1").agg(F.min("a"), F.max("a")).first()
    a, b = out.agg(F.min("a"), F.max("a")).first()
    assert lo <= a <= b <= hi
    assert out.exceptAll(split.synthetic_rows(df.repartition(5), "y", ("id",), ["a", "b"], 0.3)).count() == 0
    monkeypatch.setattr(neighbours, "CELL_ROWS", 5)
    assert out.exceptAll(split.synthetic_rows(df, "y", ("id",), ["a", "b"], 0.3)).count() == 0


def test_synthetic_rows_lie_between_neighbours(spark):
    values = [float(v) for v in (3, 1, 4, 15, 9, 2, 6, 53, 58)]
    rows = [(i, 1, v) for i, v in enumerate(values)] + [(100 + i, 0, 0.0) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, y int, a double")
    new = [r["a"] for r in split.synthetic_rows(df, "y", ("id",), ["a"], 0.3, neighbours=2).collect()]
    assert len(new) == round(60 * 0.3) - 9
    near = {v: sorted((o for o in values if o != v), key=lambda o: abs(o - v))[:2] for v in values}
    ways = [tuple(sorted((v, o))) for v, others in near.items() for o in others]
    assert all(any(lo <= v <= hi for lo, hi in ways) for v in new)


def _by_hand(points, k, scale):
    """The k nearest others of each point by trying all pairs."""
    out = {}
    for place, at, _ in points:
        if any(c is None or c != c for c in at):
            out[place] = []
            continue
        others = [
            (round(sum(((a - b) / s) ** 2 for a, b, s in zip(at, o, scale)), 10), p, load)
            for p, o, load in points
            if p != place and not any(c is None or c != c for c in o)
        ]
        out[place] = [(p, load) for _, p, load in sorted(others)[:k]]
    return out


@pytest.mark.parametrize("kind", ["lattice", "plane", "wide", "hot", "tiny"])
def test_nearest_are_the_nearest_of_all_pairs(spark, monkeypatch, kind):
    """Many small cells, ties, one point that holds a third of the rows, missing values."""
    monkeypatch.setattr(neighbours, "CELL_ROWS", 20)
    monkeypatch.setattr(neighbours, "VISITS", 50)
    rng = random.Random(kind)
    width = 6 if kind == "wide" else 2
    draw = (lambda: float(rng.randint(0, 9))) if kind in ("lattice", "hot") else (lambda: rng.gauss(0, 1))
    points = []
    for i in range(2 if kind == "tiny" else 400):
        at = [draw() for _ in range(width)]
        if kind == "hot" and i % 3 == 0:
            at = [4.0, 4.0]
        if i % 50 == 17:
            at[0] = None if i % 100 == 17 else float("nan")
        points.append((f"p{i:03d}", at, rng.choice("ab")))
    rows = spark.createDataFrame([(p, *at, load) for p, at, load in points], f"place string, {', '.join(f'c{i} double' for i in range(width))}, load string")
    names = [f"c{i}" for i in range(width)]
    scale = {c: 1.0 + i for i, c in enumerate(names)}
    found = neighbours.nearest(rows.repartition(4), F.col("place"), names, F.col("load"), 4, scale).collect()
    got = {r["place"]: [(n["place"], n["load"]) for n in r["near"]] for r in found}
    assert got == _by_hand(points, 4, list(scale.values()))


def test_cleaning_drops_rows_that_their_neighbours_contradict(spark):
    rows = [(i, "a", float(i % 10), float(i // 10)) for i in range(100)] + [(200, "b", 4.5, 4.5), (201, None, 50.0, 50.0)]
    rows += [(300 + i, "b", 100.0 + i, 0.0) for i in range(5)] + [(400, "b", None, 1.0)]
    df = spark.createDataFrame(rows, "id long, y string, a double, b double")
    kept = {r["id"] for r in split.cleaned(df, "y", ("id",), ["a", "b"]).collect()}
    assert {r[0] for r in rows} - kept == {200, 201}
    assert split.cleaned(df.limit(0), "y", ("id",), ["a", "b"]).count() == 0


def test_balanced_sample_of_any_quota(spark):
    rows = [(i, datetime.date(2024, 1 + i % 12, 1), int(i % 5 == 0)) for i in range(4000)]
    df = spark.createDataFrame(rows, "person_id long, index_month date, y_acute_90 int").repartition(7)
    for quota, positives, negatives in ((600, 600, 600), (1000, 800, 1200), (0, 0, 0)):
        got = cohort.balanced_sample(df, quota=quota).collect()
        want = []
        for y, n in ((1, positives), (0, negatives)):
            order = sorted((r for r in rows if r[2] == y), key=lambda r: (hashlib.md5(f"{r[0]}-{r[1]}".encode()).hexdigest(), r[0]))
            want += order[:n]
        assert sorted(map(tuple, got)) == sorted(want)


def test_enough_rows_already(rows):
    twice = rows.withColumn("a", F.col("id").cast("double"))
    assert split.synthetic_rows(twice, "g", ("id",), ["a"], 0.01).count() == 0


def test_no_rows(spark):
    """Every split and resampling of an empty table is empty."""
    df = spark.createDataFrame([], "id long, y int, t timestamp, a double")
    for method in ("stratified", "random", "time"):
        opts = split.SplitOptions(key=("id",), label="y", method=method, timestamp="t")
        out = split.split_rows(df, opts)
        assert "split" in out.columns and out.count() == 0
    assert split.undersample(df, "y", ("id",)).count() == 0
    assert split.oversample(df, "y", ("id",)).count() == 0
    assert split.synthetic_rows(df, "y", ("id",), ["a"]).count() == 0
    assert split.stratified_folds(df, "y", ("id",)).count() == 0


@pytest.mark.parametrize("alike", [1, 3])
def test_nearest_of_visitors_that_lie_together(spark, monkeypatch, alike):
    """Small groups of visitors compare with few points, and find the same."""
    monkeypatch.setattr(neighbours, "CELL_ROWS", 30)
    monkeypatch.setattr(neighbours, "ALIKE", alike)
    rng = random.Random(alike)
    points = [(f"p{i:03d}", [rng.gauss(0, 1), float(rng.randint(0, 3))], rng.choice(["a", None])) for i in range(300)]
    rows = spark.createDataFrame([(p, *at, load) for p, at, load in points], "place string, c0 double, c1 double, load string")
    found = neighbours.nearest(rows, F.col("place"), ["c0", "c1"], F.col("load"), 3, {"c0": 0.5, "c1": 2.0}).collect()
    assert {r["place"]: [(n["place"], n["load"]) for n in r["near"]] for r in found} == _by_hand(points, 3, [0.5, 2.0])


def test_a_search_removes_the_tables_of_its_steps(spark):
    """What stays is what the result reads; places of neighbours are numbers in the order of the texts, one for equal ones."""
    rows = spark.range(400).select(
        F.format_string("%04d", F.col("id") % 300).alias("place"), (F.col("id") % 37).cast("double").alias("c0"), F.lit(None).cast("string").alias("load")
    )
    folder = spark._jvm.org.apache.hadoop.fs.Path(work_dir(spark))
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())

    def tables():
        return {f.getPath().getName() for f in files.listStatus(folder)}

    before = tables()
    found = neighbours.nearest(rows, F.col("place"), ["c0"], F.col("load"), 3, {"c0": 1.0}, named=False)
    assert sorted(t.split("-")[0] for t in tables() - before) == ["best", "points"]
    got = {(r["id"], r["place"]): [n["place"] for n in r["near"]] for r in found.withColumn("id", F.monotonically_increasing_id()).collect()}
    named = neighbours.nearest(rows, F.col("place"), ["c0"], F.col("load"), 3, {"c0": 1.0})
    texts = {(r["place"], tuple(n["place"] for n in r["near"])) for r in named.collect()}
    numbers = sorted({n for near in got.values() for n in near})
    names = sorted({n for _, near in texts for n in near})
    assert len(got) == 400 and len(numbers) == len(names)
    say = dict(zip(numbers, names))
    assert {(place, tuple(say[n] for n in near)) for (_, place), near in got.items()} == texts
