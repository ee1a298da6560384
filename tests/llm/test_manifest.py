"""Merkle manifest against trees built by hand in Python."""

import hashlib

import pytest
from pyspark.sql import functions as F

from tabml.llm import manifest

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i : i + 3])) for i in range(0, len(out[-1]), 3)])
    return out


def siblings(tree, at):
    out = []
    for level in tree[:-1]:
        first = at // 3 * 3
        out.append((level[first:at], level[at + 1 : first + 3]))
        at //= 3
    return out


def by_hand(rows, spoilt):
    """Root, and (key, leaf, subroot, proof, folded root of the spoilt leaf) of each row."""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[name] = levels([leaf(r) for r in groups[name]])
    top = levels([trees[n][-1][0] for n in names])
    out = []
    for place, name in enumerate(names):
        for at, row in enumerate(groups[name]):
            path = siblings(trees[name], at) + siblings(top, place)
            found = leaf((*row[:4], spoilt(row)))
            for left, right in path:
                found = h("".join(left) + found + "".join(right))
            proof = h("".join("".join(a + b) for a, b in path))
            out.append((row[0], leaf(row), trees[name][-1][0], proof, found))
    return top[-1][0], out


def proven(docs, spoilt=None):
    fields = [F.col(c) for c in FIELDS]
    claim = manifest.leaf_of([*fields[:4], fields[4] if spoilt is None else spoilt])
    built = manifest.build(docs, F.col("source"), F.col("doc_id"), fields, {"doc_id": F.col("doc_id"), "claim": claim})
    found = built.prove(built.leaves).select(
        "load.doc_id", "leaf", "subroot", manifest.proof_digest(F.col("path")), manifest.folded(F.col("load.claim"), F.col("path"))
    )
    return built, [tuple(r) for r in found.collect()]


def in_order(rows):
    return sorted(rows, key=str)


def rows_of(docs):
    return [tuple(r) for r in docs.select(*FIELDS).collect()]


def test_odd_rows(odd):
    built, got = proven(odd, F.translate("text", "\n", ""))
    root, want = by_hand(rows_of(odd), lambda r: r[4] and r[4].replace("\n", ""))
    assert built.root == root
    assert in_order(got) == in_order(want)


def test_no_rows(none):
    built, got = proven(none)
    assert built.root is None and got == []


@pytest.mark.parametrize("n", [1, 2, 3, 4, 243, 244, 730, 2500])
def test_shapes_of_one_tree(spark, n):
    rows = [(i, None, None, i, f"text {i}") for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    built, got = proven(docs)
    root, want = by_hand(rows, lambda r: r[4])
    assert built.root == root
    assert in_order(got) == in_order(want)
    assert {r[4] for r in got} == {root}


def test_many_groups_and_a_dominant_one(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"s{i % 300:03d}", "en", i, f"text {i}") for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    built, got = proven(docs)
    root, want = by_hand(rows, lambda r: r[4])
    assert built.root == root and in_order(got) == in_order(want)


def test_repeated_rows_and_null_keys_are_leaves_of_their_own(spark):
    rows = [(None, "a", None, None, "same")] * 700 + [(i, "a", None, None, "same") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    built, got = proven(docs)
    root, want = by_hand(rows, lambda r: r[4])
    assert built.root == root and in_order(got) == in_order(want)


def test_requests_for_some_leaves_only(spark):
    rows = [(i, f"s{i % 7}", "en", i, f"text {i}") for i in range(1800)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    built, whole = proven(docs)
    requests = built.leaves.filter("load.doc_id % 100 = 3").withColumn("load", F.struct("load.doc_id"))
    beyond = requests.withColumn("rank", F.lit(100_000).cast("long"))
    missing = requests.withColumn("tree", F.lit("=none"))
    found = built.prove(requests.unionByName(beyond).unionByName(missing))
    got = {r["doc_id"]: r["proof"] for r in found.select("load.doc_id", manifest.proof_digest(F.col("path")).alias("proof")).collect()}
    assert got == {r[0]: r[3] for r in whole if r[0] % 100 == 3}


def test_a_changed_sibling_breaks_the_proof(spark):
    rows = [(i, "s", "en", i, f"text {i}") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    built, _ = proven(docs)
    found = built.prove(built.leaves)
    broken = F.transform("path", lambda s: F.concat(F.substring(s, 1, 1), F.reverse(F.substring(s, 2, 1 << 20))))
    assert found.filter(manifest.folded(F.col("leaf"), broken) == built.root).count() == 0
    assert found.filter(manifest.folded(F.col("leaf"), F.col("path")) == built.root).count() == 20
