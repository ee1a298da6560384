import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabml.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def filled(sizes, most=3):
    """Targets by plain water filling over {source: size}, sources in order."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, target, open_ = sum(sizes.values()), {}, set(order)
    while open_:
        share = (total - sum(target.values())) / sum(weight[s] for s in open_)
        above = {s for s in open_ if most * sizes[s] <= share * weight[s]}
        if not above:
            return target | {s: share * weight[s] for s in open_}
        target |= {s: most * sizes[s] for s in above}
        open_ -= above
    return target


def check(docs, rows):
    sizes, source_of = defaultdict(int), Counter()
    for r in docs.collect():
        n = len(WORD.findall(r["text"] or ""))
        sizes[r["source"]] += n
        source_of[r["doc_id"], r["source"], n] += 1
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in rows) == source_of
    target, taken, largest = filled(sizes), Counter(), Counter()
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - target[r["source"]]) < 1e-6 * max(1, r["target"])
        assert r["taken"] == r["size"] * len(r["positions"]) <= 3 * r["size"]
        assert list(r["positions"]) == sorted(r["positions"]) and all(0 <= p <= sum(sizes.values()) + 1e-6 for p in r["positions"])
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for s in sizes:
        assert abs(taken[s] - target[s]) <= largest[s]


def test_mix_of_a_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = mixing.mix(docs).collect()
    check(docs, rows)
    again = mixing.mix(docs.repartition(7)).collect()
    assert {r["doc_id"]: r for r in rows} == {r["doc_id"]: r for r in again}


def test_many_buckets_give_the_same(spark, sf, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = {r["doc_id"]: r for r in mixing.mix(docs).collect()}
    monkeypatch.setattr(mixing, "_BUCKET_ROWS", 3)
    assert {r["doc_id"]: r for r in mixing.mix(docs).collect()} == rows


def test_odd_input(odd, none):
    check(odd, mixing.mix(odd).collect())
    assert mixing.mix(none).collect() == []
    ordered = mixing.in_training_order(odd)
    assert ordered.columns == odd.columns
    passes = Counter()
    for r in mixing.mix(odd).collect():
        passes[r["doc_id"], r["source"], r["size"]] += len(r["positions"])
    found = Counter((r["doc_id"], r["source"], len(WORD.findall(r["text"] or ""))) for r in ordered.collect())
    assert found == +passes
    assert mixing.in_training_order(none).collect() == []


def test_nothing_but_empty_texts(spark):
    docs = spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")
    rows = mixing.mix(docs).collect()
    assert [(r["target"], r["taken"]) for r in rows] == [(0.0, 0), (0.0, 0)]


@pytest.mark.parametrize("sizes", [{"a": 5, "b": 1, "c": 1}, {"a": 1, "b": 1, "c": 10**6}, {"a": 0, "b": 3, None: 4}, {"z": 9}])
def test_targets(spark, sizes):
    rows = mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
    expected = filled(sizes)
    assert {r["source"]: round(r["target"], 6) for r in rows} == {s: round(float(t), 6) for s, t in expected.items()}


@pytest.mark.parametrize("knots", mixing.SCHEDULES.values())
def test_time_inverts_the_integral(spark, knots):
    times = np.linspace(0, 1, 2001)
    weight = np.interp(times, *zip(*knots))
    area = np.concatenate(([0], np.cumsum((weight[1:] + weight[:-1]) / 2)))
    done = np.linspace(0, 1, 41)
    expected = np.interp(done, area / area[-1], times)
    df = spark.createDataFrame([(float(d),) for d in done], "d double")
    found = [r["t"] for r in df.select("d", mixing.time_of(F.col("d"), knots).alias("t")).orderBy("d").collect()]
    assert np.allclose(found, expected, atol=1e-3)


def test_curriculum_moves_sources_over_time(spark):
    rows = [(i, "w " * 10, "abc"[i % 3]) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    early, late, total = Counter(), Counter(), 30_000
    for r in mixing.mix(docs).collect():
        for p in r["positions"]:
            (early if p < total / 2 else late)[r["source"]] += 1
    assert early["a"] > 1.3 * late["a"] and late["c"] > 1.3 * early["c"] and abs(early["b"] - late["b"]) <= 2
    # The rows come in the order of their positions.
    order = [r["doc_id"] for r in mixing.in_training_order(docs).select("doc_id").collect()]
    at = sorted((p, r["doc_id"]) for r in mixing.mix(docs).collect() for p in r["positions"])
    place = {}
    for p, k in at:
        place.setdefault(k, []).append(p)
    seen, last = Counter(), -1.0
    for k in order:
        assert place[k][seen[k]] >= last
        last = place[k][seen[k]]
        seen[k] += 1


def test_order_is_by_digest(spark):
    text = {**{i: "w" for i in range(50)}, 100: "w " * 500}
    docs = spark.createDataFrame([(k, t, "a" if k < 100 else "b") for k, t in text.items()], "doc_id long, text string, source string")
    rows = sorted((r for r in mixing.mix(docs).collect() if r["source"] == "a"), key=lambda r: r["positions"][0])
    assert [r["doc_id"] for r in rows] == sorted((r["doc_id"] for r in rows), key=lambda k: hashlib.md5(f"mix:{k}:{hashlib.md5(text[k].encode()).hexdigest()}".encode()).hexdigest())
