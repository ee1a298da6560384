"""Token counts with a digest cache.

Every text is keyed by the digest of its normalised content and the digest of the
tokenizer file. Counts found in the cache are joined; each distinct content that
is missing is encoded once, by the task that holds its representative row, and appended.
The only normalisation that keeps a byte-level count is NULL to empty, so that is the
default; another may be given.

The cache is a Parquet table (content, tokenizer, n_tokens) in the shared work folder or
wherever ``cache`` names. Appends are committed by Spark as a whole; a run that is lost
midway leaves nothing, and a content counted by two runs gives one row when read.

Only keys and digests are grouped, so a text that fills a third of the rows costs a
partial count per task and is encoded once. The join back is on the digest, with small
rows; adaptive execution splits a digest that holds too many of them.

Results for odd input: NULL counts as the empty text, with 0 bytes and 0 tokens; rows with a
NULL or repeated key are counted like any other, one row each; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabml.llm.encoding import digest_of, encoder
from tabml.llm.frames import empty_table, in_batches
from tabml.session import new_path, staged

CACHE_SCHEMA = "content binary, tokenizer string, n_tokens long"
_SLICE = 64  # texts turned into Python strings at a time


def normalised(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def stored(spark: SparkSession, cache: str) -> DataFrame:
    """The cached counts, one row per content and tokenizer; empty before the first append."""
    try:
        rows = spark.read.schema(CACHE_SCHEMA).parquet(cache)
    except (AnalysisException, Py4JJavaError):
        rows = empty_table(spark, CACHE_SCHEMA)
    return rows.groupBy("content", "tokenizer").agg(F.max("n_tokens").alias("n_tokens"))


def slices(column: pa.Array) -> Iterator[list[str | None]]:
    for i in range(0, len(column), _SLICE):
        yield column.slice(i, _SLICE).to_pylist()


def token_counts(
    docs: DataFrame,
    tokenizer: str,
    cache: str | None = None,
    key: str = "doc_id",
    text: str = "text",
    normalise=normalised,
) -> DataFrame:
    """(key, n_bytes, n_tokens, cached) for each row; ``cached``: found before this run."""
    spark = docs.sparkSession
    cache = cache or new_path(spark, "token-counts")
    version = digest_of(tokenizer)
    content = normalise(F.col(text))
    rows = docs.select(
        F.col(key).alias("key"),
        # Never NULL: the join below has to find the representative row.
        F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("null")).alias("row"),
        content.alias("text"),
        F.unhex(F.sha2(content, 256)).alias("content"),
        F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("long").alias("n_bytes"),
    )
    keys = staged(rows.drop("text"), "content-keys")
    known = stored(spark, cache).filter(F.col("tokenizer") == version).select("content", "n_tokens")
    before = staged(known.withColumn("cached", F.lit(True)), "known-counts")
    first = keys.groupBy("content").agg(F.min("row").alias("row"))
    missing = first.join(before, "content", "left_anti")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in batches:
            counts = [enc.count(t) for part in slices(batch.column("text")) for t in part]
            yield pa.RecordBatch.from_arrays(
                [batch.column("content"), pa.array(counts, pa.int64())], names=["content", "n_tokens"]
            )

    texts = rows.select("content", "row", "text").join(missing, ["content", "row"], "left_semi")
    new = in_batches(texts.select("content", "text"), counted, "content binary, n_tokens long", keeps=True).distinct()
    new.select("content", F.lit(version).alias("tokenizer"), "n_tokens").write.mode("append").parquet(cache)

    now = stored(spark, cache).filter(F.col("tokenizer") == version).select("content", "n_tokens")
    counts = now.join(before.select("content", "cached"), "content", "left")
    found = keys.join(counts, "content", "left")
    return found.select(
        F.col("key").alias(key), "n_bytes", "n_tokens", F.coalesce("cached", F.lit(False)).alias("cached")
    )

