import os
import re
from collections import Counter

import corpus_pipeline
import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tabml.llm import quality, queries, secrets
from tests_llm_brute import components


def stages(spark, sf):
    """What each stage got and what it returned."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.staged(stage(spark, docs, sf), name)
        yield name, docs, out
        docs = out


def test_stages_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"  # the smallest tables that hold secrets
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_duplicates", "secret_scans", "source_mixture", "packed_sequences"]
    for name, got, out in stages(spark, sf):
        before, after = got.collect(), out.collect()
        if name != "packed_sequences":
            assert out.columns == got.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        if name == "quality_rules":
            labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
            verdict = {r["doc_id"]: r["kept"] for r in quality.judge(got, quality.fit(got, labels)).collect()}
            assert {r["doc_id"] for r in after} == {k for k, kept in verdict.items() if kept}
        elif name == "near_duplicates":
            groups = components([(r["doc_id"], r["text"]) for r in before], percent=80, width=5)
            assert sorted(r["doc_id"] for r in after) == sorted({root for root in groups.values()})
        elif name == "secret_scans":
            assert sorted(r["doc_id"] for r in after) == sorted(r["doc_id"] for r in before)
            texts = {r["doc_id"]: r["text"] for r in before}
            assert all(r["n_chars"] == len(r["text"]) for r in after)
            again = secrets.scan(out.filter("true")).collect()
            assert not any(f["kind"] in ("access", "hex") for r in again for f in r["found"])
            assert any(texts[r["doc_id"]] != r["text"] for r in after)
        elif name == "source_mixture":
            size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
            total = sum(size(r["text"]) for r in before)
            assert abs(sum(size(r["text"]) for r in after) - total) < 0.2 * total
            assert max(Counter(r["doc_id"] for r in after).values()) <= 3
        else:
            tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
            expected = Counter()
            for r in before:
                expected[r["doc_id"]] += len(tok.encode(r["text"], add_special_tokens=False).ids) + 1
            found = Counter()
            for r in after:
                found[r["doc_id"]] += len(np.frombuffer(r["ids"], "<u4"))
            assert found == expected


def test_query_runs_all_stages(spark, sf):
    rows = queries.QUERIES["pipeline"](spark, sf)
    assert {"doc_id", "start", "length", "ids", "sequence_id", "offset"} <= set(rows.columns) and rows.count() > 0


def test_nothing_else_imports_the_subpackage():
    root = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    for folder, _, files in os.walk(root):
        if os.path.basename(folder) == "llm" or ".git" in folder:
            continue
        for f in files:
            if f.endswith(".py") and f not in ("corpus_pipeline.py", "__spark_entry__.py"):
                assert "tabml.llm" not in open(os.path.join(folder, f)).read(), f
