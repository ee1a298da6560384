"""Operators the configuration declares: date parts, differences, indicators, clipping,
correlated-column removal, cyclic months, text weights."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabml.functions.ordered import exact_quantiles
from tabml.session import staged

SMALL_TERMS = 500_000  # terms that a task may hold

PART_FUNCTIONS = {
    "year": F.year,
    "month": F.month,
    "day": F.dayofmonth,
    "dayofweek": F.weekday,  # Monday is 0
    "quarter": F.quarter,
}


def date_parts(df: DataFrame, columns: list[str], parts: tuple[str, ...] = tuple(PART_FUNCTIONS)) -> DataFrame:
    return df.withColumns({f"{c}_{p}": PART_FUNCTIONS[p](c) for c in columns for p in parts})


def day_difference(df: DataFrame, name: str, start: str, end: str) -> DataFrame:
    """Calendar days from start to end; unparseable dates give NULL."""
    days = F.datediff(F.col(end).try_cast("date"), F.col(start).try_cast("date"))
    return df.withColumn(name, days)


def missing_indicators(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({f"{c}_missing": F.col(c).isNull().cast("int") for c in columns})


def month_cycle(df: DataFrame, column: str) -> DataFrame:
    angle = F.month(column) * F.lit(2 * math.pi / 12)
    return df.withColumns({f"{column}_month_sin": F.sin(angle), f"{column}_month_cos": F.cos(angle)})


def clip_outliers(
    df: DataFrame, train: DataFrame, columns: list[str], low: float = 0.01, high: float = 0.99
) -> DataFrame:
    """Clip to the exact percentiles of the training rows; NULL stays NULL."""
    edges = {
        r["column"]: (r["lo"], r["hi"])
        for r in exact_quantiles(train, columns, {"lo": low, "hi": high}).collect()
    }

    def clip(c: str) -> Column:
        lo, hi = edges[c]
        inner = F.least(F.greatest(F.col(c), F.lit(lo)), F.lit(hi))
        return F.when(F.col(c).isNotNull(), inner)

    return df.withColumns({c: clip(c) for c in columns if c in edges})


def _pairwise(df: DataFrame, columns: list[str]) -> dict[tuple[str, str], float]:
    """Correlation of every pair over the rows where both are known, in one pass for any number of columns.

    Each task multiplies its rows' matrix [value, known, square], values standardised and 0 where missing, with
    itself: the blocks of that product hold the counts, sums, squares and products of all pairs. Entries are
    added up by place, so the driver holds one matrix of columns squared.
    """
    d = len(columns)
    typed = [F.col(f"`{c}`").cast("double") for c in columns]
    known = [F.when(~F.isnan(c), c) for c in typed]
    facts = df.agg(*[f(c).alias(f"{n}{i}") for i, c in enumerate(known) for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    mean = np.array([facts[f"m{i}"] or 0.0 for i in range(d)])
    scale = np.array([facts[f"s{i}"] or 1.0 for i in range(d)])

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((3 * d, 3 * d))
        for batch in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns], 1)
            there = ~np.isnan(x)
            x = np.where(there, (x - mean) / scale, 0.0)
            rows = np.hstack([x, there.astype(float), x * x])
            total += rows.T @ rows
        places = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(total.ravel()[places])], names=["place", "value"])

    parts = df.select(*[c.alias(f"c{i}") for i, c in enumerate(known)]).mapInArrow(products, "place long, value double")
    total = np.zeros(9 * d * d)
    for r in parts.groupBy("place").agg(F.sum("value").alias("value")).collect():
        total[r["place"]] = r["value"]
    total = total.reshape(3 * d, 3 * d)
    n, sums, squares = total[d : 2 * d, d : 2 * d], total[:d, d : 2 * d], total[2 * d :, d : 2 * d]
    with np.errstate(all="ignore"):
        spread = squares - sums * sums / n  # of the row's column over the rows that the other knows
        r = (total[:d, :d] - sums * sums.T / n) / np.sqrt(spread * spread.T)
    # A column that doesn't vary over the pair's rows has no correlation, whatever rounding says.
    r[(spread <= 1e-12 * np.maximum(squares, 1)) | (spread.T <= 1e-12 * np.maximum(squares.T, 1))] = np.nan
    return {(a, b): float(r[i, j]) for i, a in enumerate(columns) for j, b in enumerate(columns) if i < j}


def correlated_columns(df: DataFrame, columns: list[str], limit: float = 0.95) -> list[str]:
    """Columns to drop: each is correlated beyond the limit with an earlier one that stays."""
    r = _pairwise(df, columns)
    kept: list[str] = []
    dropped = []
    for c in columns:
        strong = any(abs(r[(k, c)]) > limit for k in kept)
        (dropped if strong else kept).append(c)
    return dropped


def text_weights(df: DataFrame, key: str, column: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """(key, *keep, term, tf, docs, weight): tf-idf of the lower-cased words of whole texts.

    ``docs`` counts the rows that hold the term; weight = tf * ln((rows + 1) / (docs + 1)).
    Terms are compared as they are, none collide. Rows without words give no rows. Keys
    have to tell rows apart; ``keep`` names columns of theirs that come along (rows without a key have none).

    Texts are dealt by key whole, so their terms are counted where they lie and written once; the row counts of
    terms are broadcast where they are few, else a term in most rows joins as one row that adaptive execution splits.
    """
    words = F.explode(F.split(F.lower(F.col(column)), r"\s+")).alias("term")
    dealt = df.select(key, column).repartition(key)
    terms = dealt.select(key, words).filter("term <> ''").groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))
    if keep:
        # A key that several rows share has its terms once for each of them, but counts as one. One narrow row per row.
        nth = F.row_number().over(Window.partitionBy(key).orderBy(*keep))
        told = df.filter(F.col(key).isNotNull()).select(key, *keep, (nth > 1).alias("_again"))
        terms = terms.join(told.hint("shuffle_hash"), key, "left")
    terms = staged(terms, "terms")
    counted = terms.filter("_again is null or not _again") if keep else terms
    docs = staged(counted.groupBy("term").agg(F.count(F.lit(1)).alias("docs")), "term-rows")
    size = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("term")).alias("bytes")).first()
    if size["n"] <= SMALL_TERMS and (size["bytes"] or 0) <= 32 * SMALL_TERMS:
        docs = F.broadcast(docs)
    rows = df.agg(F.count(F.lit(1))).scalar()
    if keep:
        terms = terms.filter(F.col(key).isNotNull())
    idf = F.log((rows + 1) / (F.col("docs") + 1))
    return terms.join(docs, "term").select(key, *keep, "term", "tf", "docs", (F.col("tf") * idf).alias("weight"))
