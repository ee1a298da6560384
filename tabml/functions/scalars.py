"""Null-safe scalar expressions. ANSI mode is on, so parsing uses try_cast."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_date(col: Column) -> Column:
    """Text to date; text that is a timestamp keeps its day; anything else is NULL."""
    return F.coalesce(col.try_cast("date"), col.try_cast("timestamp_ntz").cast("date"))


def safe_timestamp(col: Column) -> Column:
    return col.try_cast("timestamp")


def safe_days(col: Column) -> Column:
    """Text to a whole number of days; text that is no number is NULL."""
    return col.try_cast("decimal(38,0)").try_cast("int")


def safe_money(col: Column) -> Column:
    return col.try_cast("double")


def padded(col: Column, width: int = 3) -> Column:
    return F.lpad(col.cast("string"), width, "0")


def finite(col: Column) -> Column:
    """NaN and infinities to NULL."""
    return F.when(F.abs(col) < F.lit(math.inf), col)


def ratio(top: Column, bottom: Column) -> Column:
    """top / bottom as double, 0 where the denominator is 0."""
    return F.when(bottom == 0, F.lit(0.0)).otherwise(
        top.cast("double") / F.nullif(bottom.cast("double"), F.lit(0.0))
    )


def month_text(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM")


def clipped(col: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(col, F.lit(low)), F.lit(high))


def rescaled(col: Column, low: Column, high: Column) -> Column:
    """Min-max scaling that also works when all values are equal."""
    return (col - low) / (high - low + F.lit(1e-12))


def hash_order(*cols: Column) -> Column:
    """A reproducible pseudo-random order: the md5 of the key columns."""
    return F.md5(F.concat_ws("-", *[c.cast("string") for c in cols]))


def hash_fraction(digest: Column) -> Column:
    """The first 32 bits of a hex digest as a fraction in [0, 1)."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
