"""Merkle manifest of a dataset: a content-addressed DAG, and proofs by descent from its root.

Rows are leaves: the SHA-256 of their fields, each ``-`` if NULL, else its UTF-8 length, ``:`` and
the value. The leaves of a group, in order, are the lowest level of its tree; every ``FAN``
neighbours (the last run: fewer) become the hash of their hex digests, until one is left. The groups'
roots, in bytewise order of the groups, form the tree of the whole in the same way.

Storage: digest-to-children records. The records of ``LEVELS`` levels lie together in a pack, found
by the digest at its top: one pack for each run of 243 nodes, layer by layer, so ten thousand million
rows take five layers. Packs with equal digests are one pack.

Proofs: a request is a (tree, rank). From the root down, its rank's base-3 digits choose a child in
record after record; the children not chosen are the segment of that level. Requests with the same
leading digits descend as one, and part below a pack. The segments, reversed, lead from the
leaf up. So a request moves once, and no digest, the root's included, is looked up by more than
the packs of one layer.

Ranks come from range sorting by (group, key, digest, place): a group with most rows is many ranges.

Results for odd input: NULL fields as above; texts are hashed whole; NULL groups are one group, the
first; NULL keys come first; equal keys are ordered by their digest, equal rows by their place in the
written leaf table, and each is a leaf of its own; no rows: no root and no proofs. A request for a rank
that isn't there gives no row. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark import TaskContext

from tabml.llm.frames import partitions, small_or_plain
from tabml.session import staged

FAN, LEVELS = 3, 5
SPAN = FAN**LEVELS
RANGE_ROWS = 50_000
_SEGMENTS = "array<binary>"


def entry(column: Column) -> Column:
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*[entry(c) for c in fields]), 256)


def _hash(digests: list[bytes]) -> bytes:
    return hashlib.sha256("".join(d.hex() for d in digests).encode()).digest()


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``rank`` (from 0) in the tree and ``size``, its leaves, to rows (tree, ...).

    ``order`` has to tell all rows apart. Rows are range-sorted by tree and order and numbered
    range by range; the numbers before a range are sums over ranges.
    """
    parts = max(partitions(rows.sparkSession), -(-rows.count() // RANGE_ROWS))
    sort = [F.col("tree"), *[F.col(c).asc_nulls_first() for c in order]]
    names = rows.columns

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, n = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            local = []
            for tree in batch.column("tree").to_pylist():
                last, n = tree, n + 1 if tree == last else 0
                local.append(n)
            extra = [pa.array([part] * len(local), pa.int64()), pa.array(local, pa.int64())]
            yield pa.RecordBatch.from_arrays(batch.columns + extra, names=[*names, "_part", "_local"])

    schema = T.StructType(rows.schema.fields + [T.StructField(c, T.LongType()) for c in ("_part", "_local")])
    placed = rows.repartitionByRange(parts, *sort).sortWithinPartitions(*sort).mapInArrow(numbered, schema)
    placed = staged(placed, "ranges")
    counts = placed.groupBy("tree", "_part").agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy("tree")
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        "tree", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.sum("_n").over(whole).alias("size")
    )
    # A row per range and tree: broadcast where they are few.
    found = placed.join(small_or_plain(staged(counts, "range-counts"), 100_000), ["tree", "_part"])
    return found.withColumn("rank", F.col("_before") + F.col("_local")).drop("_part", "_local", "_before")


_PACK = "tree string, rank long, size long, digest binary, levels int, records array<struct<digest:binary,children:array<binary>>>"


def _packs(nodes: DataFrame) -> DataFrame:
    """The packs over one layer of nodes (tree, rank, size, digest)."""
    runs = nodes.groupBy("tree", F.floor(F.col("rank") / SPAN).alias("rank"), "size").agg(
        F.sort_array(F.collect_list(F.struct(F.col("rank").alias("at"), "digest"))).alias("run")
    )
    runs = runs.withColumn("run", F.col("run.digest"))

    def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {f: [] for f in ("digest", "levels", "records")}
            for size, run in zip(batch.column("size").to_pylist(), batch.column("run").to_pylist()):
                records, levels = {}, 0
                # A run that is a whole tree ends at its root, others always rise LEVELS levels.
                while levels < LEVELS if size > SPAN else len(run) > 1:
                    above = []
                    for i in range(0, len(run), FAN):
                        children = run[i : i + FAN]
                        above.append(_hash(children))
                        records[above[-1]] = children
                    run, levels = above, levels + 1
                out["digest"].append(run[0])
                out["levels"].append(levels)
                out["records"].append([{"digest": d, "children": c} for d, c in records.items()])
            record = pa.struct([("digest", pa.binary()), ("children", pa.list_(pa.binary()))])
            columns = [batch.column("tree"), batch.column("rank"), pa.array([-(-s // SPAN) for s in batch.column("size").to_pylist()], pa.int64())]
            columns += [pa.array(out["digest"], pa.binary()), pa.array(out["levels"], pa.int32()), pa.array(out["records"], pa.list_(record))]
            yield pa.RecordBatch.from_arrays(columns, names=["tree", "rank", "size", "digest", "levels", "records"])

    return runs.mapInArrow(built, _PACK)


def _grown(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Packs by layer, and (tree, digest, layers) of every tree's root, for leaves (tree, rank, size, digest)."""
    layers, tops = [], []
    most = nodes.agg(F.max("size")).first()[0] or 0
    while True:
        tops.append(nodes.filter("size = 1").select("tree", "digest", F.lit(len(layers)).alias("layers")))
        if most <= 1:
            break
        layers.append(staged(_packs(nodes.filter("size > 1")), "packs"))
        nodes, most = layers[-1].select("tree", "rank", "size", "digest"), -(-most // SPAN)
    found = tops[0]
    for more in tops[1:]:
        found = found.union(more)
    return layers, found


def _walked(front: DataFrame, asks: DataFrame, packs: DataFrame) -> DataFrame:
    """Descent through one layer: ``front`` (tree, block, digest, path, top) met by the ``asks`` for
    children of those packs (tree, block, wanted: array of (rank, load)), and the packs by digest."""
    load = asks.schema["wanted"].dataType.elementType["load"].dataType
    # Content-addressed: equal digests have equal records.
    store = packs.groupBy("digest").agg(F.first("levels").alias("levels"), F.first("records").alias("records"))
    rows = front.join(asks, ["tree", "block"]).join(store, "digest")
    rows = rows.select("tree", "digest", "path", "top", "wanted", "levels", "records")

    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column("wanted")
            for i in range(batch.num_rows):
                asked = wanted[i].values
                records = {r["digest"]: r["children"] for r in batch.column("records")[i].as_py()}
                path, levels, start = batch.column("path")[i].as_py(), batch.column("levels")[i].as_py(), batch.column("digest")[i].as_py()
                kept, digests, paths = [], [], []
                for k, rank in enumerate(asked.field("rank").to_pylist()):
                    found, segments, place = start, [], rank % SPAN
                    for level in range(levels - 1, -1, -1):
                        children, digit = records[found], place // FAN**level % FAN
                        if digit >= len(children):
                            found = None
                            break
                        segments.append(bytes([digit]) + b"".join(children[:digit] + children[digit + 1 :]))
                        found = children[digit]
                    if found is not None and place < FAN**levels:
                        kept.append(k)
                        digests.append(found)
                        paths.append(path + segments)
                if kept:
                    asked, n = asked.take(pa.array(kept)), len(kept)
                    columns = [pa.array([batch.column("tree")[i].as_py()] * n, pa.string()), asked.field("rank")]
                    columns += [pa.array(digests, pa.binary()), pa.array(paths, pa.list_(pa.binary()))]
                    columns += [pa.array([batch.column("top")[i].as_py()] * n, pa.binary()), asked.field("load")]
                    yield pa.RecordBatch.from_arrays(columns, names=["tree", "rank", "digest", "path", "top", "load"])

    schema = T.StructType().add("tree", "string").add("rank", "long").add("digest", "binary")
    schema = schema.add("path", T.ArrayType(T.BinaryType())).add("top", "binary").add("load", load)
    return rows.mapInArrow(walked, schema)


def _asked(requests: DataFrame, depth: int) -> DataFrame:
    """Requests (tree, rank, load) as asks for the children of layer ``depth``: leaves, or the packs below."""
    block = F.floor(F.col("rank") / SPAN ** (depth + 1)).alias("block")
    child = F.floor(F.col("rank") / SPAN**depth).alias("rank")
    if depth:
        requests = requests.select("tree", block, child, F.lit(0).alias("load")).distinct()
    else:
        requests = requests.select("tree", block, child, "load")
    return requests.groupBy("tree", "block").agg(F.collect_list(F.struct("rank", "load")).alias("wanted"))


def _descended(requests: DataFrame, tops: DataFrame, layers: list[DataFrame]) -> DataFrame:
    """(tree, rank, digest, path, top, load) of requests (tree, rank, load).

    ``tops`` (tree, digest, layers, path, top): every tree's root with the path that leads there.
    """
    front, requests = None, requests.select("tree", "rank", "load")
    for depth in range(len(layers) - 1, -1, -1):
        begin = tops.filter(F.col("layers") == depth + 1).select("tree", F.lit(0).cast("long").alias("block"), "digest", "path", "top")
        front = begin if front is None else begin.union(front.select("tree", "rank", "digest", "path", "top"))
        front = _walked(front, _asked(requests, depth), layers[depth])
    single = tops.filter("layers = 0").join(requests.filter("rank = 0"), "tree")
    single = single.select("tree", "rank", "digest", "path", "top", "load")
    return single if front is None else single.union(front)


@dataclass
class Manifest:
    """``leaves`` (tree, group, rank, digest, load); packs by layer; the groups' trees in the tree of the whole."""

    leaves: DataFrame
    layers: list[DataFrame]
    tops: DataFrame
    groups: DataFrame
    group_layers: list[DataFrame]
    group_tops: DataFrame
    root: str | None

    def prove(self, requests: DataFrame) -> DataFrame:
        """(leaf, subroot, path, load) for each request (tree, rank, load); the path leads from the leaf up."""
        asks = requests.select("tree").distinct().join(self.groups, "tree")
        asks = asks.select(F.col("whole").alias("tree"), "rank", F.struct("tree").alias("load"))
        begin = self.group_tops.select("tree", "digest", "layers", F.array().cast(_SEGMENTS).alias("path"), F.col("digest").alias("top"))
        reached = _descended(asks, begin, self.group_layers).select(F.col("load.tree").alias("tree"), "digest", "path")
        tops = reached.join(self.tops.select("tree", "layers"), "tree")
        found = _descended(requests, tops.withColumn("top", F.col("digest")), self.layers)
        return found.select(
            F.lower(F.hex("digest")).alias("leaf"), F.lower(F.hex("top")).alias("subroot"), F.reverse("path").alias("path"), "load"
        )


def tree_of(group: Column) -> Column:
    """A group's name in the manifest: never NULL, in the order of the groups, NULL first."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def build(docs: DataFrame, group: Column, key: Column, fields: list[Column], load: dict[str, Column]) -> Manifest:
    """The manifest of ``docs``; ``load`` are columns that the leaf table keeps for later requests."""
    leaves = docs.select(
        tree_of(group).alias("tree"),
        key.alias("key"),
        F.unhex(leaf_of(fields)).alias("digest"),
        F.monotonically_increasing_id().alias("place"),
        F.struct(*[c.alias(n) for n, c in load.items()]).alias("load"),
    )
    leaves = staged(ranked(staged(leaves, "leaves"), ["key", "digest", "place"]), "leaves")
    layers, tops = _grown(leaves.select("tree", "rank", "size", "digest"))
    tops = staged(tops, "tree-roots")
    groups = tops.select(F.lit("").alias("tree"), F.col("tree").alias("group"), "digest")
    groups = staged(ranked(groups, ["group"]), "groups")
    group_layers, group_tops = _grown(groups.select("tree", "rank", "size", "digest"))
    group_tops = staged(group_tops, "root")
    top = group_tops.first()
    return Manifest(
        leaves.select("tree", "rank", "digest", "load"),
        layers,
        tops,
        groups.select(F.col("group").alias("tree"), F.col("tree").alias("whole"), "rank"),
        group_layers,
        group_tops,
        None if top is None else bytes(top["digest"]).hex(),
    )


def _hex(segment: Column) -> Column:
    return F.lower(F.hex(F.substring(segment, 2, 1 << 20)))


def proof_digest(path: Column) -> Column:
    """Hash of the siblings along a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, _hex), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf (hex) and the siblings on its path lead to."""

    def step(found: Column, segment: Column) -> Column:
        cut = F.conv(F.hex(F.substring(segment, 1, 1)), 16, 10).cast("int") * 64
        digests = _hex(segment)
        rest = F.substr(digests, cut + 1, F.length(digests))
        return F.sha2(F.concat(F.substr(digests, F.lit(1), cut), found, rest), 256)

    return F.aggregate(path, leaf, step)
