"""A training corpus from raw documents: rules, near duplicates, secrets, mixture, packing.

Each stage takes (spark, docs, sf_dir), works on all documents that the stage before it left,
and returns a DataFrame that is written as Parquet and read again for the next one. All but
the last return the columns of ``documents``:

* quality rules drop the documents they reject;
* the n-gram Jaccard join leaves one document of each group of near duplicates, by five words and
  80 %;
* secret scans replace what they find by the kind in brackets (``n_chars`` follows);
* mixing leaves each document once for every pass that takes it, in training order;
* packing returns the pieces of the training sequences with their token ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabml.llm import jaccard, mixing, packing, quality, secrets
from tabml.llm.frames import table
from tabml.session import staged


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return quality.keep(docs, quality.fit(docs, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each(docs, width=5, percent=80)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = secrets.redact(docs)
    if "n_chars" not in docs.columns:
        return clean
    # A document without a text keeps the number it came with.
    length = F.coalesce(F.char_length("text").cast(docs.schema["n_chars"].dataType), "n_chars")
    return clean.withColumn("n_chars", length)


def source_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.in_training_order(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2, drops_space=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("secret_scans", secret_scans),
    ("source_mixture", source_mixture),
    ("packed_sequences", packed_sequences),
]

# Token ids come from the tokenizer library, so SQL can't give the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
