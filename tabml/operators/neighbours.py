"""Exact nearest neighbours of rows, cell by cell, without comparing all pairs.

Equal points are one point first, with the ``k`` + 1 smallest places that it holds: more of them
can't be among anybody's ``k`` nearest, so a point that holds most rows is as cheap as another. The
points are dealt into cells by a k-d tree over a bounded sample (the cuts balance the work only), and
each looks at its own cell; the distance of the k-th candidate then tells which other cells, by
their exact boxes, may hold a nearer point, and it looks there as well. Many columns make the boxes overlap,
and more cells are looked at. A cell with many visitors is copied, so that a task holds
``VISITS`` of them and one cell. Visitors are taken ``ALIKE`` at a time, by a k-d tree again: points that are farther
from their box than the k-th can be are not compared with each of them.

Distances are Euclidean, each column divided by its scale, and rounded to ten digits of their square; ties go
to the smaller place. Rows whose point has a NULL or NaN are no neighbours and have none.

Places are texts and long, so on the way they are numbers in the same order; equal places have one number. What a step
has written or shuffled is removed once the next step is written.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabml.session import let_go, new_path, removed, staged

CELL_ROWS = 1_000
MOST_CELLS = 16_384
SAMPLE_PER_CELL = 32
VISITS = 20_000
ALIKE = 64  # visitors that lie together and look at the same points of a cell
_NEAR = "array<struct<d2:double,place:long,at:array<double>,load:string>>"
_HELD = "array<struct<place:long,load:string>>"
DIGITS = 10


class Tables:
    """Written tables of one search; those that nothing reads any more are removed, and shuffle files with them."""

    def __init__(self, spark: SparkSession):
        self.spark, self.path = spark, {}

    def put(self, name: str, rows: DataFrame) -> DataFrame:
        self.path[name] = new_path(self.spark, name)
        rows.write.parquet(self.path[name])
        let_go(self.spark)
        return self.spark.read.parquet(self.path[name])

    def drop(self, *names: str) -> None:
        for name in names:
            removed(self.spark, self.path.pop(name))


class Cells:
    """A k-d tree: inner nodes cut one column, leaves are cells."""

    def __init__(self, sample: np.ndarray, cells: int):
        self.column, self.cut, self.left, self.cell = [], [], [], []
        self.n = 0
        self._grow(sample, max(1, cells))

    def _grow(self, rows: np.ndarray, cells: int) -> int:
        node = len(self.column)
        self.column.append(-1)
        self.cut.append(0.0)
        self.left.append((-1, -1))
        self.cell.append(-1)
        wide = np.ptp(rows, axis=0) if len(rows) else np.zeros(1)
        if cells > 1 and wide.max() > 0:
            c = int(wide.argmax())
            values = np.sort(rows[:, c])
            cut = values[(len(values) - 1) // 2]
            if cut == values[-1]:
                cut = values[np.searchsorted(values, cut) - 1]
            low = rows[:, c] <= cut
            self.column[node], self.cut[node] = c, float(cut)
            left = self._grow(rows[low], cells // 2)
            self.left[node] = (left, self._grow(rows[~low], cells - cells // 2))
        else:
            self.cell[node], self.n = self.n, self.n + 1
        return node

    def of(self, points: np.ndarray) -> np.ndarray:
        out = np.zeros(len(points), np.int64)
        stack = [(0, np.arange(len(points)))]
        while stack:
            node, rows = stack.pop()
            if self.cell[node] >= 0:
                out[rows] = self.cell[node]
            elif len(rows):
                low = points[rows, self.column[node]] <= self.cut[node]
                stack += [(self.left[node][0], rows[low]), (self.left[node][1], rows[~low])]
        return out

    def boxed(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Boxes of all nodes from those of the cells; a cell without rows has an empty box."""
        lows, highs = np.full((len(self.column), low.shape[1]), np.inf), np.full((len(self.column), low.shape[1]), -np.inf)
        for node in range(len(self.column) - 1, -1, -1):
            if self.cell[node] >= 0:
                lows[node], highs[node] = low[self.cell[node]], high[self.cell[node]]
            else:
                a, b = self.left[node]
                lows[node], highs[node] = np.minimum(lows[a], lows[b]), np.maximum(highs[a], highs[b])
        return lows, highs


def _points(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _answers(asks: pa.Table, hosts: pa.Table, k: int, scale: np.ndarray) -> pa.Table:
    """The ``k`` + 1 nearest candidates of one cell for every visitor, within its reach."""
    kind = pa.struct([("d2", pa.float64()), ("place", pa.int64()), ("at", pa.list_(pa.float64())), ("load", pa.string())])
    schema = pa.schema([("pid", pa.int64()), ("near", pa.list_(kind))])
    if not len(asks) or not len(hosts):
        return schema.empty_table()
    pids, places = asks.column("pid").combine_chunks(), hosts.column("at").combine_chunks()
    queries, points = _points(asks.column("at").combine_chunks(), len(scale)), _points(places, len(scale))
    held = hosts.column("held").combine_chunks()
    sizes, rows = pc.list_value_length(held).to_numpy(zero_copy_only=False).astype(np.int64), held.flatten()
    names, loads = rows.field("place"), rows.field("load").cast(pa.string())
    rank = names.to_numpy()
    starts = np.cumsum(sizes) - sizes
    most = min(k, len(points) - 1)
    out = []
    reaches = asks.column("reach").to_numpy()
    scaled = points / scale
    together = Cells(queries / scale, -(-len(queries) // ALIKE)).of(queries / scale)
    turn = np.argsort(together, kind="stable")
    cuts = np.flatnonzero(np.diff(together[turn])) + 1
    groups = [g[i : i + 256] for g in np.split(turn, cuts) for i in range(0, len(g), 256)]
    for mine in groups:
        block, reach = queries[mine], reaches[mine] * (1 + 1e-9) + 1e-9
        low, high = (block / scale).min(axis=0), (block / scale).max(axis=0)
        nearest_way = np.maximum(np.maximum(low - scaled, scaled - high), 0)
        farthest_way = np.maximum(np.abs(scaled - low), np.abs(high - scaled))
        bound = np.partition((farthest_way * farthest_way).sum(1), most)[most] * (1 + 1e-9) + 1e-9
        chosen = np.flatnonzero((nearest_way * nearest_way).sum(1) <= min(bound, reach.max()))
        if not len(chosen):
            continue
        some = points[chosen]
        d2 = np.zeros((len(block), len(some)))
        for c in range(some.shape[1]):
            d2 += ((block[:, c, None] - some[None, :, c]) / scale[c]) ** 2
        d2 = np.round(d2, DIGITS)
        last = min(most, len(some) - 1)
        edge = np.minimum(np.partition(d2, last, axis=1)[:, last], reach)
        query, column = np.nonzero(d2 <= edge[:, None])
        apart, point = d2[query, column], chosen[column]
        # One entry per row that such a point holds, the k + 1 first of each query by distance and place.
        many = sizes[point]
        query, point, apart = np.repeat(query, many), np.repeat(point, many), np.repeat(apart, many)
        entry = starts[point] + np.arange(len(point)) - np.repeat(np.cumsum(many) - many, many)
        order = np.lexsort((rank[entry], apart, query))
        query, point, entry, apart = query[order], point[order], entry[order], apart[order]
        few = np.arange(len(query)) - np.searchsorted(query, query) <= k
        query, point, entry, apart = query[few], point[few], entry[few], apart[few]
        found = [pa.array(apart), names.take(pa.array(entry)), places.take(pa.array(point)), loads.take(pa.array(entry))]
        found = pa.StructArray.from_arrays([f.cast(t.type) for f, t in zip(found, kind)], fields=list(kind))
        ends = np.searchsorted(query, np.arange(len(block) + 1)).astype(np.int32)
        near = pa.ListArray.from_arrays(pa.array(ends), found).cast(schema.field("near").type)
        out.append(pa.Table.from_arrays([pids.take(pa.array(mine)), near], schema=schema))
    return pa.concat_tables(out) if out else schema.empty_table()


def nearest(
    rows: DataFrame, place: Column, columns: list[str], load: Column, k: int, scales: dict[str, float], named: bool = True
) -> DataFrame:
    """``rows`` with ``near``: the ``k`` nearest other rows as (d2, place, at, load), nearest first.

    ``place`` is a text that identifies the row, ``load`` a text that neighbours bring along. Without ``named``, the
    places of neighbours stay numbers, which saves a join.
    """
    scale = np.array([scales[c] or 1.0 for c in columns])
    width = len(columns)
    entries = [F.col(f"`{c}`").cast("double") + F.lit(0.0) for c in columns]  # -0.0 becomes 0.0
    given = rows.withColumns({"_place": place, "_load": load.cast("string"), "_at": F.array(*entries)})
    whole = F.forall("_at", lambda c: c.isNotNull() & ~F.isnan(c))
    tables = Tables(rows.sparkSession)
    # Ranges of places lie in order, so that the window needs no other exchange.
    given = given.repartitionByRange("_place").sortWithinPartitions("_place").withColumn("_first", F.monotonically_increasing_id())
    given = given.withColumn("_no", F.min("_first").over(Window.partitionBy("_place"))).drop("_first")
    given = tables.put("points", given)
    first = Window.partitionBy("_at").orderBy("_no")
    kept = given.filter(whole).select("_at", "_no", "_load", F.row_number().over(first).alias("_n")).filter(F.col("_n") <= k + 1)
    points = kept.groupBy("_at").agg(
        F.sort_array(F.collect_list(F.struct(F.col("_no").alias("place"), F.col("_load").alias("load")))).alias("held")
    )
    points = tables.put("distinct-points", points.select(F.monotonically_increasing_id().alias("pid"), F.col("_at").alias("at"), "held"))
    n = points.count()
    cells = min(MOST_CELLS, max(1, n // CELL_ROWS))
    share = min(1.0, cells * SAMPLE_PER_CELL / max(n, 1))
    draw = F.pmod(F.xxhash64("at"), F.lit(1 << 30)) / float(1 << 30)
    sample = points.filter(draw < share).orderBy("pid").select("at").toArrow().column("at").combine_chunks()
    tree = Cells(_points(sample, width) / scale if len(sample) else np.zeros((0, width)), cells)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = tree.of(_points(batch.column("at"), width) / scale)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], names=["pid", "at", "held", "cell"])

    points = tables.put("cells", points.mapInArrow(dealt, f"pid long, at array<double>, held {_HELD}, cell long"))
    tables.drop("distinct-points")
    ends = [f(F.get("at", F.lit(c))).alias(f"{name}{c}") for c in range(width) for name, f in (("low", F.min), ("high", F.max))]
    # One row a cell, MOST_CELLS of them at most.
    boxes = points.groupBy("cell").agg(*ends).collect()
    low, high = np.full((tree.n, width), np.inf), np.full((tree.n, width), -np.inf)
    for b in boxes:
        low[b["cell"]] = [b[f"low{c}"] / scale[c] for c in range(width)]
        high[b["cell"]] = [b[f"high{c}"] / scale[c] for c in range(width)]
    lows, highs = tree.boxed(low, high)

    def answered(asks: DataFrame, name: str) -> DataFrame:
        many = asks.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / VISITS).alias("copies"))
        many = F.broadcast(tables.put(f"{name}-copies", many))  # one row a cell
        chunk = F.pmod(F.xxhash64("pid"), F.col("copies")).alias("chunk")
        visitors = asks.join(many, "cell").select(F.col("pid").alias("pid"), F.col("at").alias("at"), F.col("reach").alias("reach"), F.col("cell").alias("to"), chunk)
        copies = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("part")
        hosts = points.join(many, "cell").select(F.col("at").alias("at"), F.col("held").alias("held"), F.col("cell").alias("here"), copies)
        return visitors.groupBy("to", "chunk").cogroup(hosts.groupBy("here", "part")).applyInArrow(
            lambda a, b: _answers(a, b, k, scale), f"pid long, near {_NEAR}"
        )

    own = tables.put("own-cell", answered(points.select("pid", "at", "cell", F.lit(float("inf")).alias("reach")), "own"))
    reach = F.when(F.size("near") > k, F.element_at("near", -1)["d2"]).otherwise(F.lit(float("inf"))).alias("reach")
    asking = own.select("pid", reach).join(points.select("pid", "at", "cell"), "pid").select("pid", "at", "cell", "reach")

    def further(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = _points(batch.column("at"), width) / scale
            reach, mine = batch.column("reach").to_numpy(), batch.column("cell").to_numpy()
            reach = reach * (1 + 1e-9) + 1e-9
            stack = [(0, np.arange(len(at)))]
            while stack:
                node, active = stack.pop()
                away = np.maximum(np.maximum(lows[node] - at[active], at[active] - highs[node]), 0)
                active = active[(away * away).sum(1) <= reach[active]]
                if not len(active):
                    continue
                if tree.cell[node] < 0:
                    stack += [(child, active) for child in tree.left[node]]
                    continue
                active = active[mine[active] != tree.cell[node]]
                if len(active):
                    take = pa.array(active)
                    cell = pa.array(np.full(len(active), tree.cell[node]))
                    yield pa.RecordBatch.from_arrays([batch.column(c).take(take) for c in ("pid", "at", "reach")] + [cell], names=["pid", "at", "reach", "cell"])

    asks = tables.put("visits", asking.mapInArrow(further, "pid long, at array<double>, reach double, cell long"))
    found = own.unionByName(answered(asks, "further")).groupBy("pid").agg(F.flatten(F.collect_list("near")).alias("all"))
    best = found.select("pid", F.slice(F.sort_array("all"), 1, k + 1).alias("all")).join(points.select("pid", "at"), "pid")
    best = tables.put("best", best.select(F.col("at").alias("_at"), "all"))
    tables.drop("own-cell", "visits", "cells", "own-copies", "further-copies")
    joined = given.join(best, "_at", "left")
    others = F.slice(F.filter("all", lambda x: x["place"] != F.col("_no")), 1, k)
    near = F.when(whole, F.coalesce(others, F.array().cast(_NEAR))).otherwise(F.array().cast(_NEAR))
    joined = joined.withColumn("near", near).drop("all", "_at", "_load")
    return (_named(joined, given) if named else joined).drop("_no")


def _named(joined: DataFrame, given: DataFrame) -> DataFrame:
    """The places of neighbours as the texts that they were given as."""
    joined = joined.withColumn("_row", F.monotonically_increasing_id())
    joined = staged(joined, "numbered-neighbours")
    texts = given.select(F.col("_no").alias("_number"), F.col("_place").alias("_text")).distinct()
    each = joined.select("_row", F.posexplode("near").alias("_at", "_n")).join(texts, F.col("_n.place") == F.col("_number"))
    entry = F.struct("_at", F.struct("_n.d2", F.col("_text").alias("place"), F.col("_n.at").alias("at"), "_n.load").alias("n"))
    near = each.groupBy("_row").agg(F.transform(F.sort_array(F.collect_list(entry)), lambda e: e["n"]).alias("near"))
    empty = F.array().cast("array<struct<d2:double,place:string,at:array<double>,load:string>>")
    return joined.drop("near").join(near, "_row", "left").withColumn("near", F.coalesce("near", empty)).drop("_row")


def spreads(rows: DataFrame, columns: list[str]) -> dict[str, float]:
    """Population deviation of each column; 1 where it doesn't vary."""
    found = rows.agg(*[F.stddev_pop(F.col(f"`{c}`").cast("double")).alias(f"s{i}") for i, c in enumerate(columns)]).first()
    return {c: found[f"s{i}"] or 1.0 for i, c in enumerate(columns)}
