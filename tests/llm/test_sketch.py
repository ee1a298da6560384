import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tabml.llm import queries, sketch

COARSE = re.compile(r"(?:[^ \t\n\x0b\f\r]+[ \t\x0b\f\r]*){1,32}")
LINE = re.compile(r"[^\n]+")
WORD = re.compile(r"[^ \t\n\x0b\f\r]+[ \t\x0b\f\r]*")


def paragraph_set(text):
    """Every 32 words of a line; in texts of up to 600 characters also after words with one of the last characters."""
    text = text or ""
    if len(text) > 600:
        return {p.rstrip(" ") for p in COARSE.findall(text)}
    out = set()
    for line in LINE.findall(text):
        part = []
        for word in WORD.findall(line):
            part.append(word)
            if word.rstrip(" \t\x0b\f\r")[-1] in ".,;:!?dgi07" and word[-1] in " \t\x0b\f\r" or len(part) == 32:
                out.add("".join(part).rstrip(" "))
                part = []
        if part:
            out.add("".join(part).rstrip(" "))
    return out


def likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def edit(text, following):
    n = len(text)
    return text[: n - n // 3] + following[: n // 3]


def check(rows, order):
    """``order``: the texts by descending key; every row against brute force."""
    follow = {k: (t or "", order[(i + 1) % len(order)][1] or "") for i, (k, t) in enumerate(order)}
    assert len(rows) == len(order)
    for r in rows:
        text, after = follow[r["doc_id"]]
        changed = edit(text, after)
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        own, new, nxt = map(paragraph_set, (text, changed, after))
        assert r["different_edited"] == len(own ^ new) and r["different_next"] == len(own ^ nxt)
        assert abs(r["near_edited"] - likeness(own, new)) < 1e-12 and abs(r["near_next"] - likeness(own, nxt)) < 1e-12
        assert (r["fingerprint"] == r["edited_fingerprint"]) == (own == new)


def test_query_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    check(queries.op8_paragraph_sketch(spark, sf).collect(), sorted(((r[0], r[1]) for r in docs), reverse=True))


def test_equal_texts_have_equal_fingerprints(spark, odd):
    rows = sketch.versions(odd).collect()
    assert len(rows) == odd.count()
    of = {}
    for r in odd.filter("doc_id in (100, 101, 109)").collect():
        of[r["doc_id"]] = r["text"]
    prints = {r["fingerprint"] for r in rows if r["doc_id"] in of}
    assert len(set(of.values())) == 1 and len(prints) == 1
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in rows)


def test_neighbours_of_odd_rows(odd, none):
    pairs = [(r["key"], r["text"], r["next_text"]) for r in sketch.with_next(odd).collect()]
    assert len(pairs) == odd.count()
    assert sorted(t for _, t, _ in pairs) == sorted(n for *_, n in pairs)  # everyone follows one row
    keys = {}
    for k, t, _ in pairs:
        keys.setdefault(t, set()).add(k)
    low = lambda k: -1 if k is None else k
    lowest = min(low(k) for k, *_ in pairs)
    steps = [(low(k), max(low(x) for x in keys[n] if low(x) <= low(k)) if any(low(x) <= low(k) for x in keys[n]) else None) for k, _, n in pairs]
    order = sorted({low(k) for k, *_ in pairs}, reverse=True)
    for k, n in steps:
        at = order.index(k)
        assert n is None and k == lowest or n == k or n is not None and (at + 1 < len(order) and n <= k)
    assert sketch.with_next(none).collect() == [] and sketch.versions(none).collect() == []


def test_one_row_follows_itself(spark):
    one = spark.createDataFrame([(5, "some words\nmore")], "doc_id long, text string")
    check(sketch.versions(one).collect(), [(5, "some words\nmore")])


def test_sparse_and_clustered_keys(spark):
    rng = random.Random(6)
    keys = [*range(50), *(10**15 + i for i in range(50)), -(10**17), *(rng.randint(-(10**6), 10**6) for _ in range(30))]
    rows = [(k, f"text {k}\n" * rng.randint(1, 4)) for k in set(keys)]
    found = {r["key"]: r["next_text"] for r in sketch.with_next(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()}
    order = sorted(rows, reverse=True)
    assert found == {k: order[(i + 1) % len(order)][1] for i, (k, _) in enumerate(order)}


@pytest.mark.parametrize("cells", [12, 96])
def test_large_differences_are_retried(spark, cells, monkeypatch):
    # Too small a first guess: every pair has to be tried again, some several times.
    monkeypatch.setattr(sketch, "_enough", lambda squares: F.lit(cells))
    rng = random.Random(7)
    rows = []
    for i in range(30):
        shared, a, b = rng.randint(0, 40), rng.randint(0, 150), rng.randint(0, 150)
        rows.append((i, [f"s{i}-{k}" for k in range(shared + a)], [f"s{i}-{k}" for k in range(shared)] + [f"o{i}-{k}" for k in range(b)], a + b))
    df = spark.createDataFrame(rows, "pair long, one array<string>, other array<string>, d long")
    hashed = df.select("pair", "d", *[F.transform(c, lambda x: F.xxhash64(x)).alias(c) for c in ("one", "other")])
    found = sketch.differences(hashed, {"x": ("one", "other")}).join(df, "pair").collect()
    assert len(found) == 30 and all(r["x"] == r["d"] for r in found)


def test_likeness_bounds(spark):
    df = spark.createDataFrame([(0, 0, 0), (3, 0, 3), (4, 4, 0), (3, 3, 2)], "a int, b int, d int")
    got = [r[0] for r in df.select(sketch.likeness(F.col("a"), F.col("b"), F.col("d"))).collect()]
    assert got == [1.0, 0.0, 1.0, 0.5]


@pytest.mark.parametrize("kind", ["large", "text", "shared"])
def test_order_is_that_of_the_key(spark, kind):
    """Numbers that doubles can't tell apart, and text keys."""
    rng = random.Random(8)
    keys = [2**53 + i for i in range(60)] + [2**62 + i for i in range(40)]
    if kind != "large":
        keys = [f"{'prefix/' if kind == 'shared' else ''}{''.join(rng.choice('abzé-') for _ in range(rng.randint(0, 9)))}{i % 40}" for i in range(100)]
    rows = [(k, f"text of {k}\nand more {i}") for i, k in enumerate(sorted(set(keys)))]
    order = sorted(rows, key=lambda r: r[0].encode() if kind != "large" else r[0], reverse=True)
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, f"doc_id {'long' if kind == 'large' else 'string'}, text string").repartition(5)
    check(sketch.versions(docs).collect(), order)


def test_short_lines_keep_a_likeness(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    rows = [(i, " ".join(word() for _ in range(40))) for i in range(60)]
    near = [r["near_edited"] for r in sketch.versions(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sum(near) / len(near) > 0.3


def test_only_white_space_is_trimmed(spark):
    """The first paragraph keeps a 0 at its end, the second a 1; spaces go."""
    texts = ["text 30\nmore 21", "text 3\nmore 2", "text 30 \nmore 21  "]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, text string")
    found = dict(df.select("i", sketch.paragraphs(F.col("text"))).collect())
    assert not set(found[0]) & set(found[1]) and found[0] == found[2]
