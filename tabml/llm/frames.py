"""Spark helpers of the operators: tables, hold-out remainders, bounded samples."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabml.llm.text import released


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def remainder(key: Column, parts: int) -> Column:
    """crc32 of the key as text, modulo ``parts``; NULL for a NULL key."""
    return F.crc32(key.cast("string").cast("binary")) % parts


def picked(key: Column, share: float | Column, seed: int = 7) -> Column:
    """True for about ``share`` of the keys, always the same ones."""
    draw = F.pmod(F.xxhash64(F.lit(seed), key.cast("string")), F.lit(1 << 30)) / float(1 << 30)
    return draw < share


_CLASSES = 100_000


def sample_of(keys: DataFrame, by: str, size: int) -> DataFrame:
    """``keys`` (key, ``by``) thinned to about ``size`` rows per value of ``by``.

    Adds ``weight``: how many rows each kept row stands for. Values of ``by`` are classes:
    their counts are a few rows, checked, and broadcast.
    """
    counts = keys.groupBy(by).agg(F.count(F.lit(1)).alias("_n")).limit(_CLASSES + 1).toArrow()
    if counts.num_rows > _CLASSES:
        raise ValueError(f"values of {by}: more than {_CLASSES} rows")
    # As Arrow: Python rows would start Python workers of their own, which stay beside those of the texts.
    counts = F.broadcast(keys.sparkSession.createDataFrame(counts))
    share = F.least(F.lit(1.0), F.lit(float(size)) / F.col("_n"))
    kept = keys.join(counts, by).filter(picked(F.col("key"), share))
    return kept.withColumn("weight", 1.0 / share).drop("_n")


def free_name(name: str, taken: list[str]) -> str:
    """``name``, lengthened until no column has it."""
    while name.lower() in {c.lower() for c in taken}:
        name += "_"
    return name


def quoted(columns: list[str]) -> list[str]:
    return [f"`{c.replace('`', '``')}`" for c in columns]


def empty_table(spark: SparkSession, schema: str) -> DataFrame:
    """No rows of ``schema``; an empty list of Python rows would start Python workers."""
    fields = T.StructType.fromDDL(schema)
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])


def small_or_plain(df: DataFrame, rows: int) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``rows`` rows, else as it is."""
    return F.broadcast(df) if df.count() <= rows else df


BATCH_ROWS = 2_000


def in_batches(rows: DataFrame, work: Callable, schema, keeps: bool = False) -> DataFrame:
    """``rows.mapInArrow`` for texts: batches of ``BATCH_ROWS`` rows at most, and workers that return
    their memory, but for what ``work`` keeps from task to task if it ``keeps`` anything.
    The session's Arrow batch size is lowered for that, never raised."""
    conf, name = rows.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(conf.get(name, "10000"))
    if now <= 0 or now > BATCH_ROWS:
        conf.set(name, str(BATCH_ROWS))
    return rows.mapInArrow(lambda batches: released(work, batches, keeps), schema)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
