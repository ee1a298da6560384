"""Packing tokenised texts into sequences of a fixed length in bounded space.

Each partition keeps at most ``open_windows`` windows that are not full. A text's ids go
to the open window where they fit best (least room left); when they fit none, and
no window may be opened, the fullest window is emitted. If its room is at least
``least_cut`` ids, the text's first ids fill it before. Whole windows of a long text are
emitted as they are. At its end a partition merges its open windows into full ones,
and one window that is not full stays; those leftovers are merged across partitions,
``FAN_IN`` at a time, level by level, until a single one remains, which is padded.

A task holds ``open_windows`` windows, one batch of texts and the ids of about a megabyte
of them, whatever the size of the partition. The level results are written tables, so a
lost executor repeats tasks of one level only. Ids are little-endian unsigned 32-bit numbers.

Results for odd input: NULL and empty texts are just their end id; repeated rows, or rows
with the same or a NULL key, are packed as texts of their own; an empty table gives no
piece; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabml.llm.encoding import encoder
from tabml.llm.frames import in_batches
from tabml.llm.text import blocks, utf8
from tabml.session import staged

FAN_IN = 256
_LEVEL, _PART = 1 << 56, 1 << 28  # sequence number: level, partition or group, counter


@dataclass(eq=False)
class Window:
    """Pieces of one sequence: (text's key, start, ids, text's length)."""

    pieces: list = field(default_factory=list)
    size: int = 0

    def add(self, piece: tuple) -> None:
        self.pieces.append(piece)
        self.size += len(piece[2]) // 4


def _cut(piece: tuple, ids: int) -> tuple[tuple, tuple]:
    key, start, body, total = piece
    return (key, start, body[: 4 * ids], total), (key, start + ids, body[4 * ids :], total)


class Packer:
    """Online best fit over a bounded set of open windows."""

    def __init__(self, length: int, open_windows: int, least_cut: int):
        self.length, self.most, self.least_cut = length, open_windows, least_cut
        self.open: list[tuple[int, int, Window]] = []  # (room, number, window), ascending
        self.opened = 0

    def add(self, piece: tuple) -> Iterator[Window]:
        while len(piece[2]) // 4 >= self.length:
            head, piece = _cut(piece, self.length)
            full = Window()
            full.add(head)
            yield full
        size = len(piece[2]) // 4
        if not size:
            return
        at = bisect_left(self.open, (size,))
        if at < len(self.open):
            _, _, window = self.open.pop(at)
        else:
            window = Window()
            if len(self.open) >= self.most:
                room, _, fullest = self.open.pop(0)
                if room >= self.least_cut:
                    head, piece = _cut(piece, room)
                    fullest.add(head)
                yield fullest
        window.add(piece)
        if window.size == self.length:
            yield window
        else:
            self.opened += 1
            insort(self.open, (self.length - window.size, self.opened, window))

    def close(self) -> tuple[list[Window], Window]:
        """Full windows merged from the open ones, and the one that is left."""
        rest = [p for _, _, w in self.open for p in w.pieces]
        self.open = []
        return merged(rest, self.length)


def merged(pieces: list[tuple], length: int) -> tuple[list[Window], Window]:
    """Fill windows with the pieces one after the other, cutting at the borders."""
    full, last = [], Window()
    for piece in pieces:
        while len(piece[2]) // 4 > length - last.size:
            head, piece = _cut(piece, length - last.size)
            if head[2]:
                last.add(head)
            full.append(last)
            last = Window()
        if piece[2]:
            last.add(piece)
    if last.size == length:
        full.append(last)
        last = Window()
    return full, last


COLUMNS = ["key", "start", "ids", "doc_tokens", "sequence_id", "offset", "left_by"]


def _rows(window: Window, sequence: int, left_by: int | None) -> Iterator[tuple]:
    offset = 0
    for key, start, ids, total in window.pieces:
        yield key, start, ids, total, sequence, offset, left_by
        offset += len(ids) // 4


def packed(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    length: int = 4096,
    open_windows: int = 64,
    least_cut: int = 16,
    drops_space: bool = False,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per piece: key, start, length, ids, doc_tokens, sequence_id, offset.

    ``start`` counts the text's ids before the piece, ``offset`` the sequence's. Each text
    ends with ``end_id``. ``drops_space``: the vocabulary has no token for white space.
    """
    end = np.array([end_id], "<u4").tobytes()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType
    schema = T.StructType(
        [T.StructField("key", kind), T.StructField("start", T.LongType()), T.StructField("ids", T.BinaryType())]
        + [T.StructField(c, T.LongType()) for c in COLUMNS[3:]]
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        enc, packer, made, out = encoder(tokenizer, drops_space), Packer(length, open_windows, least_cut), 0, []
        key_type = None

        def batch_of(lines: list[tuple]) -> pa.RecordBatch:
            kinds = [key_type, pa.int64(), pa.binary(), *[pa.int64()] * 4]
            columns = [pa.array(list(c), k) for c, k in zip(zip(*lines), kinds)]
            return pa.RecordBatch.from_arrays(columns, names=COLUMNS)

        for batch in batches:
            key_type = batch.column("key").type
            keys = iter(batch.column("key").to_pylist())
            column = batch.column("text")
            for i, j, *_ in blocks(*utf8(column)):
                for body in enc.encode_all([t or "" for t in column.slice(i, j - i).to_pylist()]):
                    ids = body + end
                    for window in packer.add((next(keys), 0, ids, len(ids) // 4)):
                        out += _rows(window, part * _PART + made, None)
                        made += 1
                if len(out) >= 2000:
                    yield batch_of(out)
                    out = []
        full, last = packer.close()
        for window in full:
            out += _rows(window, part * _PART + made, None)
            made += 1
        out += _rows(last, part * _PART + made, part)
        if out:
            yield batch_of(out)

    tables, level = [], 0
    pieces = staged(in_batches(rows, pack, schema, keeps=True), "packed")
    while True:
        tables.append(pieces.filter(F.col("left_by").isNull()))
        left = pieces.filter(F.col("left_by").isNotNull())
        parts = left.agg(F.max("left_by")).first()[0]
        if parts is None:
            break
        level += 1
        if parts == 0:  # a single window: the last one, padded
            tables.append(left)
            break
        pieces = staged(_merged_left(left, schema, length, level), "packed-left")
    found = reduce(DataFrame.unionByName, tables)
    length_of = (F.octet_length("ids") / 4).cast("long").alias("length")
    return found.select(F.col("key").alias(key), "start", length_of, "ids", "doc_tokens", "sequence_id", "offset")


def _merged_left(left: DataFrame, schema: T.StructType, length: int, level: int) -> DataFrame:
    """The leftovers of ``FAN_IN`` neighbours, at most so many windows, merged by one task."""

    def merge(group: tuple, lines: pd.DataFrame) -> pd.DataFrame:
        lines = lines.sort_values(["left_by", "offset"], kind="stable")
        pieces = list(zip(lines["key"], lines["start"], lines["ids"], lines["doc_tokens"]))
        full, last = merged(pieces, length)
        first, out = level * _LEVEL + int(group[0]) * _PART, []
        for i, window in enumerate(full):
            out += _rows(window, first + i, None)
        out += _rows(last, first + len(full), int(group[0]))
        made = pd.DataFrame(out, columns=COLUMNS)
        made["left_by"] = made["left_by"].astype("Int64")
        return made

    # Keys travel as text: pandas has no whole number that is NULL.
    plain = left.withColumn("key", F.col("key").cast("string"))
    text_schema = T.StructType([T.StructField("key", T.StringType()), *schema.fields[1:]])
    group = F.floor(F.col("left_by") / FAN_IN).alias("left_group")
    done = plain.groupBy(group).applyInPandas(merge, text_schema)
    return done.withColumn("key", F.col("key").cast(schema["key"].dataType))
