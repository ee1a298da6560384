"""Left join to a table with one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SMALL_ROWS, SMALL_BYTES = 100_000, 8_000_000


def lookup(left: DataFrame, table: DataFrame, key: str, rows: int | None = None) -> DataFrame:
    """``left`` with the table's columns; rows without a match keep NULLs.

    A table known to have few rows, and found to have few bytes, is broadcast. A larger one is
    joined on its key: each key has one row there, and adaptive execution splits the partitions
    in which a frequent key, or NULL, gathers too many rows of ``left``.
    """
    if rows is not None and rows <= SMALL_ROWS:
        size = F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0))
        if table.agg(size).first()[0] <= SMALL_BYTES:
            table = F.broadcast(table)
    return left.join(table, key, "left")
