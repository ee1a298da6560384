import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabml.llm import jaccard, queries
from tabml.llm import text as tx

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width=4):
    words = WORD.findall((text or "").translate(UPPER))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def brute(rows, percent=85):
    """(key, size, component) of every row; rows with the same key are one node."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            same = len(sets[i] & sets[j])
            linked = sets[i] and sets[j] and 100 * same >= percent * (len(sets[i]) + len(sets[j]) - same)
            if linked or rows[i][0] is not None and rows[i][0] == rows[j][0] and sets[i] and sets[j]:
                parent[root(i)] = root(j)
    keys = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            keys[root(i)] = min(key, keys.get(root(i), key))
    return Counter((k, len(s), keys.get(root(i)) if s else k) for i, ((k, _), s) in enumerate(zip(rows, sets)))


def result(df):
    return Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect())


def test_query_against_brute_force(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert result(queries.op5_jaccard_product(spark, sf)) == brute(rows)


def test_odd_input(odd, none):
    assert result(jaccard.similar_groups(odd)) == brute([(r["doc_id"], r["text"]) for r in odd.collect()])
    assert jaccard.similar_groups(none).collect() == []


def near_copies(rng, n, words=60):
    """Groups around some bases, with a passage that most texts share; links in chains and just missed."""
    passage = [f"p{i}" for i in range(30)]
    rows, bases = [], [[f"w{rng.randint(0, 4000)}" for _ in range(rng.randint(8, words))] for _ in range(6)]
    for i in range(n):
        text = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
            text[rng.randrange(len(text))] = f"e{rng.randint(0, 300)}"
        if rng.random() < 0.5:
            text += passage
        if rng.random() < 0.1:
            text = text[: rng.randint(0, 5)]
        rows.append((i, " ".join(text)))
    return rows


@pytest.mark.parametrize("common", [0, 1 << 17])
def test_many_near_copies(spark, monkeypatch, common):
    monkeypatch.setattr(jaccard, "N_COMMON", max(common, 1))
    rows = near_copies(random.Random(4), 400)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert result(jaccard.similar_groups(docs)) == brute(rows)


def test_text_keys_and_other_similarity(spark):
    rows = [(f"k{i:03}", t) for i, t in near_copies(random.Random(9), 150)]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    assert result(jaccard.similar_groups(docs, percent=50)) == brute(rows, 50)


def test_common_grams_only_reorder(spark):
    hashes = np.random.default_rng(0).integers(0, 2**63, 1000, dtype=np.uint64)
    common = np.sort(hashes[:100]), np.full(100, 5)
    code = jaccard.coded(hashes, common)
    assert (code[:100] >> 58 == 5).all() and (code[100:] >> 58 == 0).all() and len(set(code)) == 1000


def test_short_texts_are_one_gram():
    column = ["a b", "a  b", "b a", "a", "", "a b c", "a b c d"]
    import pyarrow as pa

    hashes, bounds = jaccard.grams_of(*tx.utf8(pa.array(column)), 4)
    assert np.diff(bounds).tolist() == [1, 1, 1, 1, 0, 1, 1]
    assert hashes[0] == hashes[1] and len(set(hashes.tolist())) == 5


def test_components_of_chains_and_stars(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 60)] + [(300, 200), (250, 300)]
    rng.shuffle(links)
    found = {r["node"]: r["root"] for r in jaccard.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(1, 41)} | {100 + i: 100 for i in range(1, 60)} | {300: 200, 250: 200}
    assert jaccard.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_one_of_each(spark, odd, none):
    stay = jaccard.one_of_each(odd)
    assert stay.columns == odd.columns
    kept = Counter(r["doc_id"] for r in stay.collect() if r["doc_id"] is not None)
    groups = {(k, c) for k, _, c in result(jaccard.similar_groups(odd)) if k is not None}
    assert set(kept) == {k for k, c in groups} - {k for k, c in groups if k != c}
    assert max(kept.values()) == 1
    assert jaccard.one_of_each(none).collect() == []
    plain = spark.createDataFrame([(2, "a b c d e"), (1, "a b c d e"), (3, "x y z u v")], "doc_id long, text string")
    assert {r["doc_id"] for r in jaccard.one_of_each(plain).collect()} == {1, 3}
    assert jaccard.one_of_each(plain.withColumn("gone", F.lit(1))).count() == 2
