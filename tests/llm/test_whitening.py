"""Whitening against numpy's own eigendecomposition, and the rank-one updates on their own."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabml.llm import whitening
from tabml.llm.spectrum import Spectrum, rank_one

SCHEMA = "vec_id long, embedding array<float>, label int"


def lattice(vectors):
    return np.floor(np.asarray(vectors, np.float32).astype(float) * 64).astype(np.int64) + 1_000_000


def by_hand(vectors, width=16):
    x = lattice(vectors)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(0)
    centred = fit - sums / n
    values, components = np.linalg.eigh(centred.T @ centred / n)
    values, components = values[::-1][:width], components[:, ::-1][:, :width]
    with np.errstate(all="ignore"):
        scored = (x - sums / n) @ components / np.sqrt(values)
    return n, ((n * x - sums) ** 2).sum(1), scored, values / (centred * centred).sum() * n


def check(rows, vectors, keys, width=16):
    got = rows.toPandas()
    n, deviation, scored, explained = by_hand(vectors, width)
    width = min(width, scored.shape[1])
    assert len(got) == len(keys) * width
    assert set(got.n) == {n}
    assert got.identity_error.max() <= 1e-9 and got.identity_error.nunique() == 1
    for i, key in enumerate(keys):
        mine = got[got.vec_id == key].sort_values("component")
        assert list(mine.component) == list(range(1, width + 1))
        assert set(mine.deviation) == {int(deviation[i])}
        assert np.allclose(np.abs(mine.whitened), np.abs(scored[i]), atol=1e-8)
        assert np.allclose(mine.explained, explained, rtol=1e-10)


def frame(spark, vectors, keys=None):
    rows = [(int(k), [float(c) for c in v], 0) for k, v in zip(keys if keys is not None else range(len(vectors)), vectors)]
    return spark.createDataFrame(rows, SCHEMA)


def test_given_table(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet")
    seen = rows.collect()
    check(whitening.whitened(rows), [r["embedding"] for r in seen], [r["vec_id"] for r in seen])


def test_repeated_vectors_are_fitted_once(spark):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(90, 6)) * np.arange(1, 7)
    vectors = np.concatenate([vectors, np.repeat(vectors[:1], 45, 0)])
    rows = frame(spark, vectors)
    check(whitening.whitened(rows), vectors, range(len(vectors)))


def test_bad_vectors_are_dropped(spark):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(40, 5))
    bad = [None, [1.0, None, 0.0, 0.0, 0.0], [math.nan] * 5, [math.inf, 0, 0, 0, 0], [1.0, 2.0], [], [3e38] * 5]
    rows = frame(spark, vectors).union(spark.createDataFrame([(1000 + i, v and [c if c is None else float(c) for c in v], 0) for i, v in enumerate(bad)], SCHEMA))
    rows = rows.withColumns({c: F.lit("clash") for c in ("x", "n", "component", "whitened", "part", "_x", "_near", "sums")})
    check(whitening.whitened(rows), vectors, range(40))


def test_null_and_repeated_keys(spark):
    rng = np.random.default_rng(5)
    rows = frame(spark, rng.normal(size=(30, 4)), [1] * 10 + list(range(20)))
    rows = rows.withColumn("vec_id", F.expr("nullif(vec_id, 5)"))
    got = whitening.whitened(rows, components=2)
    assert got.count() == 60 and got.filter("vec_id = 1").count() == 22 and got.filter("vec_id is null").count() == 2


def test_too_few_vectors(spark):
    got = whitening.whitened(frame(spark, [[0.5, 0, 0], [0, 0, 0.25]])).orderBy("vec_id", "component").collect()
    assert [r["whitened"] is None for r in got] == [False, True, True] * 2
    assert abs(abs(got[0]["whitened"]) - 1) < 1e-12 and got[0]["identity_error"] < 1e-12
    assert got[0]["explained"] == pytest.approx(1)
    one = whitening.whitened(frame(spark, [[0.5, 0, 0]] * 3)).collect()
    assert len(one) == 9 and {(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one} == {(1, 0, None, None, None)}


def test_no_rows(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").limit(0)
    got = whitening.whitened(rows)
    assert got.collect() == []
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_large_entries_stay_exact(spark):
    vectors = np.array([[2.0**30, 0, 1], [0, 2.0**20, 1], [1, 1, 0.0], [5, 3, 2]])
    got = {r["vec_id"]: r["deviation"] for r in whitening.whitened(frame(spark, vectors)).collect()}
    x = lattice(vectors).astype(object)
    exact = [int(((4 * r - x.sum(0)) ** 2).sum()) for r in x]
    assert got == {i: (d if d < 2**63 else None) for i, d in enumerate(exact)}
    assert None in got.values() or max(exact) < 2**63


@pytest.mark.parametrize("kind", ["plain", "repeats", "few", "axes", "clusters"])
def test_rank_one_updates_and_merges(kind):
    rng = np.random.default_rng(1)
    n, size = (20, 40) if kind == "few" else (300, 12)
    x = np.floor(rng.normal(size=(n, size)) * 9).astype(np.int64) + 1_000_000
    if kind == "repeats":
        x = x[rng.integers(0, 4, n)]
    if kind == "axes":
        x = 1_000_000 + 3 * np.eye(size, dtype=np.int64)[rng.integers(0, size, n)]
    if kind == "clusters":
        x = x + 500 * np.eye(size, dtype=np.int64)[rng.integers(0, 3, n)]
    whole = None
    for part in np.array_split(x, 4):
        one = Spectrum.empty(part[0])
        for row in part:
            one.add(row)
        if whole is None:
            whole = one
        else:
            whole.merge(one)
    centred = x - x.mean(0)
    scatter = centred.T @ centred
    largest = max(np.abs(scatter).max(), 1.0)
    assert np.allclose(whole.vectors.T @ whole.vectors, np.eye(size), atol=1e-11)
    assert np.abs(whole.vectors * whole.values @ whole.vectors.T - scatter).max() < 1e-11 * largest
    assert np.abs(whole.values - np.linalg.eigvalsh(scatter)).max() < 1e-11 * largest


def test_deflation_keeps_pairs_that_do_not_change():
    d, u = np.array([1.0, 2.0, 2.0, 5.0]), np.eye(4)
    values, vectors = rank_one(d, u, np.array([0, 1.0, 1.0, 0]), 3.0)
    assert np.allclose(np.sort(values), [1, 2, 5, 8])
    assert np.allclose(vectors * values @ vectors.T, np.diag(d) + 3 * np.outer([0, 1, 1, 0], [0, 1, 1, 0]))
