import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabml.llm import language, queries

LETTERS = {"aa": "abcdef", "bb": "efghij", "cc": "ijklmn", "dd": "mnopqr", "ee": "qrstuv"}


def made(spark, langs, n=60):
    rng = random.Random(1)
    rows = []
    for i in range(n * len(langs)):
        lang = langs[i % len(langs)]
        rows.append((i, " ".join("".join(rng.choice(LETTERS[lang]) for _ in range(5)) for _ in range(20)), lang))
    return spark.createDataFrame(rows, "key long, text string, lang string")


def test_codewords_differ():
    for n in (2, 3, 5, 7, 9, 40):
        code = language.codewords(n)
        far = (code.shape[1] - code @ code.T) / 2 + 1e9 * np.eye(n)
        assert far.min() >= 1 and set(np.unique(code)) == {-1.0, 1.0}
    assert ((language.codewords(40) @ language.codewords(40).T).max(1) > 0).all()


@pytest.mark.parametrize("langs", [["aa", "bb"], ["aa", "bb", "cc", "dd", "ee"]])
def test_learns_made_languages(spark, langs):
    rows = made(spark, langs)
    model = language.fit(rows.filter("key % 3 <> 1"))
    found = language.predict(rows.filter("key % 3 = 1"), model, key="key").join(rows, "key").collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in found]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in found)


def test_decoding_corrects_a_wrong_bit():
    code = language.codewords(4)
    model = language.LanguageModel(list("abcd"), code, None, np.ones(7), np.zeros(7), np.ones(7))
    margins = 2 * code.copy()
    margins[np.arange(4), np.arange(4)] *= -1  # one wrong bit in each row
    best, score, gap = language.decoded(model, margins)
    assert best.tolist() == [0, 1, 2, 3] and (gap > 0).all() and (score > 0.25).all()
    assert language.decoded(model, np.zeros((1, 7)))[2][0] == 0  # nothing known: ambiguous


def test_odd_input(spark, odd, none):
    model = language.fit(odd.drop("key").withColumnRenamed("doc_id", "key"))
    rows = language.predict(odd, model).collect()
    assert len(rows) == odd.count()
    expected = {r["doc_id"]: r["text"] for r in odd.collect() if r["doc_id"] is not None and r["doc_id"] != 103}
    for r in rows:
        assert 0 <= r["score"] <= 1
        if r["doc_id"] in expected:
            letters = any(c.isalpha() for c in expected[r["doc_id"]] or "")
            assert (r["lang_pred"] == "und") == (not letters)
    assert language.predict(none, model).collect() == []
    empty = language.fit(none.drop("key").withColumnRenamed("doc_id", "key"))
    assert {r["lang_pred"] for r in language.predict(odd, empty).collect()} == {"und"}
    one = language.fit(odd.drop("key").withColumnRenamed("doc_id", "key").filter("lang = 'es'"))
    assert {r["lang_pred"] for r in language.predict(odd, one).collect()} == {"und", "es"}


def test_query_accuracy_on_held_out(spark, sf):
    found = queries.op1_language_codes(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = found.filter("held_out and lang is not null").select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert held > 0.95
