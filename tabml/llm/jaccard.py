"""N-gram Jaccard join as a blocked sparse product of the document by n-gram incidence.

Rows of the incidence matrix are classes of texts with the same set of word n-grams,
columns are n-grams. The product of the matrix with its transpose would hold the overlap of
every pair; only the cells that can reach the similarity are formed:

* Columns are ordered from rare to frequent, so that each row's first few columns, its
  prefix, are its rarest. Two rows similar enough share a column of their prefixes.
* Cells of the prefix product are formed block by block of columns (the shuffle partitions),
  and dropped at once when the rows' sizes, or the columns still to come in
  each, leave too little room for the overlap needed.
* The overlap counted inside the prefixes plus the most that can come after
  them discards most other cells; the rest get their overlap from whole rows.

The order of columns follows counts of frequent n-grams: those found in several texts of
a chunk, summed over chunks: whole powers of two from the top, ``N_COMMON`` at most. Any order gives the same
result; it only decides how many cells are formed.

A large group of near copies would form a cell for each of its pairs. So some rounds form
star cells first: with each column's most popular row (the one with the most rows in its
columns, the likely original) instead of all pairs, and of each row the few that share
the most columns. Their links are merged into components, and all other cells are formed only
between rows of different components. Cells inside a component can't change the components, so
none is lost.

n-grams are 64-bit hashes. Rows travel by a number: the key, if it is a whole number, else
its hash. Intermediate tables lie in the shared work folder.

Results for odd input: texts without words (NULL, empty, white space) have size 0 and
are their own component; fewer than ``width`` words make one n-gram of the whole sequence;
rows with the same key are one document, linked to whatever any of them links to; a row with
a NULL key is a document of its own text, and its component the smallest key linked
to it, NULL if none; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabml.llm import text as tx
from tabml.llm.frames import free_name, in_batches, quoted, small_or_plain
from tabml.session import staged

N_COMMON = 1 << 18  # frequent n-grams whose order is known: at most 3 MB broadcast
_CHUNK = 2_000_000  # n-grams that a task counts at a time
_LOCAL, _TOTAL = 2, 8  # texts of a chunk, and of such counts together, that make an n-gram frequent
_ROUNDS, _STARS = 3, 2  # rounds of star cells, and cells of a row in each
_SMALL = 1_000_000  # rows of one number that may be broadcast


def grams_of(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of each text of a block, and where each text's begin."""
    starts, ends, bounds = tx.words(data, offsets)
    words = tx.segment_hashes(data, starts, ends)
    hashes, where = tx.window_hashes(words, bounds, width)
    text = tx.texts_of(bounds)[where]
    count = np.diff(bounds)
    short = np.flatnonzero((count > 0) & (count < width))
    if len(short):
        # The whole sequence; its length keeps it apart from other sequences.
        rest = np.zeros(len(short), np.uint64)
        for k in range(width):
            has = count[short] > k
            rest[has] = tx.mixed(rest[has] + words[bounds[short[has]] + k]) + np.uint64(k + 1)
        hashes, text = np.concatenate([hashes, rest]), np.concatenate([text, short])
        order = np.argsort(text, kind="stable")
        hashes, text = hashes[order], text[order]
    first = ~tx.repeated(hashes, text)[1]
    hashes, text = hashes[first], text[first]
    return hashes, np.searchsorted(text, np.arange(len(offsets)))


def _totals(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of 64-bit numbers, modulo 2^64, for each text."""
    upto = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)))
    return upto[bounds[1:]] - upto[bounds[:-1]]


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    lowered = F.translate(F.col(text), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return docs.select(F.col(key).alias("key"), lowered.alias("text"))


def _number(kind: T.DataType) -> Column:
    """The row number of a document: its key, or a hash where that is no whole number."""
    whole = isinstance(kind, (T.LongType, T.IntegerType, T.ShortType, T.ByteType))
    key = F.col("key").cast("long") if whole else F.when(F.col("key").isNotNull(), F.xxhash64(F.col("key").cast("string")))
    return F.coalesce(key, F.col("d1"))


def sizes(docs: DataFrame, width: int, key: str, text: str) -> DataFrame:
    """(key, n, d1, d2, grams, counts): set sizes and digests; each chunk's frequent n-grams in one row."""
    rows = _rows(docs, key, text)

    def frequent(seen: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        gram, times = np.unique(np.concatenate(seen), return_counts=True)
        often = times >= _LOCAL
        return gram[often].view(np.int64), times[often].astype(np.int64)

    def finished(columns: list, lists: tuple | None) -> pa.RecordBatch:
        """The batch, with the frequent n-grams of a chunk in its first row."""
        rest = [None] * (len(columns[0]) - 1)
        grams, counts = ([None], [None]) if lists is None else ([lists[0]], [lists[1]])
        columns = [*columns, pa.array(grams + rest, pa.list_(pa.int64())), pa.array(counts + rest, pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays(columns, names=["key", "n", "d1", "d2", "grams", "counts"])

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, size, last, lists = [], 0, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            if last is not None:
                yield finished(last, lists)
            n, d1, d2, lists = [], [], [], None
            for _, _, data, offsets in tx.blocks(*tx.utf8(batch.column("text"))):
                hashes, bounds = grams_of(data, offsets, width)
                n.append(np.diff(bounds))
                d1.append(_totals(tx.mixed(hashes + np.uint64(1)), bounds))
                d2.append(_totals(tx.mixed(hashes ^ np.uint64(0x5851F42D4C957F2D)), bounds))
                seen.append(hashes)
                size += len(hashes)
            if size >= _CHUNK:
                lists, seen, size = frequent(seen), [], 0
            last = [
                batch.column("key"),
                pa.array(np.concatenate(n).astype(np.int64)),
                _signed(np.concatenate(d1)),
                _signed(np.concatenate(d2)),
            ]
        if last is not None:
            if lists is None and seen:
                lists = frequent(seen)
            yield finished(last, lists)

    numbers = [T.StructField(c, T.LongType()) for c in ("n", "d1", "d2")]
    lists = [T.StructField(c, T.ArrayType(T.LongType())) for c in ("grams", "counts")]
    return in_batches(rows, measured, T.StructType([rows.schema["key"], *numbers, *lists]))


def common_grams(found: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent n-grams, sorted, and their frequency bands; at most ``N_COMMON``."""
    pairs = found.filter(F.size("grams") > 0).select(F.explode(F.arrays_zip("grams", "counts")).alias("p"))
    counts = pairs.groupBy(F.col("p.grams").alias("gram")).agg(F.sum("p.counts").alias("n")).filter(F.col("n") >= _TOTAL)
    counts = staged(counts, "frequent-grams")
    # How many n-grams are in how many texts, by power of two: the bands that fit.
    bands = counts.groupBy(F.floor(F.log2("n")).alias("band")).agg(F.count(F.lit(1)).alias("grams"))
    least, total = None, 0
    for band, grams in sorted(map(tuple, bands.collect()), reverse=True):
        total += grams
        if total > N_COMMON:
            break
        least = band
    top = counts.filter(F.lit(False) if least is None else F.floor(F.log2("n")) >= least).toArrow()
    gram = top.column("gram").to_numpy().astype(np.int64).view(np.uint64)
    band = (1 + np.minimum(np.log2(np.maximum(top.column("n").to_numpy(), 1)), 29)).astype(np.uint8)
    order = np.argsort(gram)
    return gram[order], band[order]


def coded(hashes: np.ndarray, common: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Column numbers that order n-grams from rare to frequent."""
    gram, band = common
    code = (hashes >> np.uint64(6)).astype(np.int64)
    if len(gram):
        at = np.minimum(np.searchsorted(gram, hashes), len(gram) - 1)
        code += np.where(gram[at] == hashes, band[at], 0).astype(np.int64) << 58
    return code


def incidence(docs: DataFrame, common: tuple[np.ndarray, np.ndarray], width: int, percent: int | None, key: str, text: str) -> DataFrame:
    """(key, n, d1, d2, columns): each text's columns in order, cut to the prefix for ``percent``."""
    rows = _rows(docs, key, text)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in tx.blocks(*tx.utf8(batch.column("text"))):
                hashes, bounds = grams_of(data, offsets, width)
                n = np.diff(bounds)
                text_of = tx.texts_of(bounds)
                code = coded(hashes, common)
                code = code[np.lexsort((code, text_of))]
                keep = n if percent is None else np.where(n > 0, n - (percent * n + 99) // 100 + 1, 0)
                place = np.arange(len(code)) - np.repeat(bounds[:-1], n)
                kept = code[place < np.repeat(keep, n)]
                ends = np.concatenate(([0], np.cumsum(keep))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("key").slice(i, j - i),
                        pa.array(n.astype(np.int64)),
                        _signed(_totals(tx.mixed(hashes + np.uint64(1)), bounds)),
                        _signed(_totals(tx.mixed(hashes ^ np.uint64(0x5851F42D4C957F2D)), bounds)),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(kept)),
                    ],
                    names=["key", "n", "d1", "d2", "columns"],
                )

    numbers = [T.StructField(c, T.LongType()) for c in ("n", "d1", "d2")]
    schema = T.StructType([rows.schema["key"], *numbers, T.StructField("columns", T.ArrayType(T.LongType()))])
    return in_batches(rows, listed, schema)


# ---------------------------------------------------------------- components


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every linked node that isn't its component's smallest.

    ``links`` (a, b). Alternates two steps until nothing changes: each node's larger neighbours,
    then its smaller ones, are tied to the smallest node around it. The number of rounds grows
    with the logarithm of the longest chain; no step gathers a component in one place.
    """
    edges = staged(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "links"
    )

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    seen = mark(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        near = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(near, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        edges = staged(small.distinct(), "links")
        now = mark(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


# ---------------------------------------------------------------- the join


def _need(percent: int, n: Column, m: Column) -> Column:
    """Least overlap of sets of n and m members that are similar enough."""
    return F.ceil(F.lit(percent) * (n + m) / F.lit(100 + percent))


def _room(percent: int, a: str, b: str) -> Column:
    """Size bounds of the cell of two rows at a common column: can the overlap be large enough?"""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    left = F.least(n - F.col(f"{a}.pos"), m - F.col(f"{b}.pos"))
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (left >= _need(percent, n, m))


def _cell(a: str, b: str) -> list[Column]:
    """A pair of rows, whichever way round it was found."""
    return [F.least(f"{a}.node", f"{b}.node").alias("a"), F.greatest(f"{a}.node", f"{b}.node").alias("b")]


def _mixed(shared: DataFrame, roots: DataFrame | None) -> DataFrame:
    """The columns that hold rows of several components, with each row's ``root``."""
    column = Window.partitionBy("col")
    named = shared.withColumn("root", F.col("node"))
    if roots is not None:
        named = shared.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = named.withColumn("lo", F.min("root").over(column)).withColumn("hi", F.max("root").over(column))
    return named.filter("lo <> hi").select("col", "node", "n", "pos", "popular", "root")


def _star_cells(mixed: DataFrame, percent: int) -> DataFrame:
    """Cells of each column's most popular row with the rows of other components: of a row's
    cells the ``_STARS`` that share the most columns."""
    first = F.max(F.struct("popular", "node", "n", "pos", "root")).over(Window.partitionBy("col"))
    stars = mixed.select(F.struct("node", "n", "pos", "root").alias("b"), first.alias("a"))
    stars = stars.filter(F.col("a.root") != F.col("b.root")).filter(_room(percent, "a", "b"))
    stars = stars.groupBy(F.col("b.node").alias("row"), *_cell("a", "b")).agg(F.count(F.lit(1)).alias("columns"))
    most = Window.partitionBy("row").orderBy(F.desc("columns"), "a", "b")
    best = stars.withColumn("place", F.row_number().over(most)).filter(F.col("place") <= _STARS)
    return best.select("a", "b").distinct()


def _similar(pairs: DataFrame, rows: DataFrame, docs: DataFrame, common, width: int, percent: int, key: str, text: str) -> DataFrame:
    """The pairs (a, b) that are similar: overlap bounded by the prefixes, then counted on whole rows."""
    n, m = F.col("na"), F.col("nb")

    def side(of: DataFrame, name: str) -> DataFrame:
        return of.select(F.col("node").alias(name), F.col("n").alias(f"n{name}"), F.col("columns").alias(f"c{name}"))

    both = pairs.join(side(rows, "a"), "a").join(side(rows, "b"), "b")
    shared = F.size(F.array_intersect("ca", "cb"))
    a_ends_first = F.element_at("ca", -1) <= F.element_at("cb", -1)
    after = F.when(a_ends_first, n - F.size("ca")).otherwise(m - F.size("cb"))
    likely = staged(both.filter(shared + after >= _need(percent, n, m)).select("a", "b").distinct(), "cells")

    wanted = staged(likely.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "cell-rows")
    kind = docs.schema[key].dataType
    number = _number(kind)
    wanted = small_or_plain(wanted, _SMALL)  # 8 bytes each
    # Texts with a key are picked by it; those without show their number only with their digest.
    tagged = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).withColumn("d1", F.lit(None).cast("long"))
    tagged = tagged.withColumn("node", number).drop("d1")
    chosen = tagged.filter("key is not null").join(wanted, "node", "left_semi").drop("node")
    chosen = chosen.unionByName(tagged.filter("key is null").drop("node"))
    whole = incidence(chosen, common, width, None, "key", "text").withColumn("node", number)
    full = likely.join(side(whole, "a"), "a").join(side(whole, "b"), "b")
    overlap = F.size(F.array_intersect("ca", "cb"))
    return full.filter(100 * overlap >= percent * (n + m - overlap)).select("a", "b").distinct()


def similar_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 4, percent: int = 85) -> DataFrame:
    """(key, n_shingles, component_id) for each row.

    Two documents link when 100 * overlap >= percent * union of their sets of ``width`` words.
    """
    kind = docs.schema[key].dataType
    number = _number(kind)
    found = staged(sizes(docs, width, key, text), "gram-sizes")
    common = common_grams(found)
    members = found.select("key", "n", "d1", "d2").withColumn("node", number)
    classes = members.filter("n > 0").groupBy("d1", "d2").agg(F.min("node").alias("node"))

    prefixes = incidence(docs, common, width, percent, key, text).filter("n > 0").withColumn("node", number)
    rows = staged(prefixes.join(classes, ["d1", "d2", "node"], "left_semi").select("node", "n", "columns"), "incidence")

    # Blocks of columns: every row that has a column in its prefix meets in the column's partition.
    cells = rows.select("node", "n", F.posexplode("columns").alias("pos", "col"))
    cells = cells.withColumn("rows", F.count(F.lit(1)).over(Window.partitionBy("col")))
    shared = staged(cells.filter("rows > 1"), "shared-columns")
    popular = shared.groupBy("node").agg(F.sum("rows").alias("popular"))
    shared = staged(shared.drop("rows").join(popular, "node"), "popular-rows")

    # A key with several texts ties their classes together.
    texts = members.filter("n > 0").select("node", "d1", "d2").distinct()
    several = texts.groupBy("node").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1").select("node")
    same = texts.join(several, "node").join(classes.withColumnRenamed("node", "b"), ["d1", "d2"]).select(F.col("node").alias("a"), "b")
    links = staged(same, "links-of-keys")

    def similar(pairs: DataFrame) -> DataFrame:
        return staged(_similar(pairs, rows, docs, common, width, percent, key, text), "new-links")

    tried, roots = None, None if links.isEmpty() else components(links)
    for _ in range(_ROUNDS):
        pairs = _star_cells(staged(_mixed(shared, roots), "mixed-columns"), percent)
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = staged(pairs, "star-cells")
        new = similar(pairs)
        if new.isEmpty():
            break
        # A component is its roots' star: old links beyond that add nothing.
        known = new if roots is None else new.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b")))
        roots = components(known)
        tried = pairs if tried is None else tried.unionByName(pairs)

    mixed = staged(_mixed(shared, roots), "mixed-columns")
    one, other = mixed.alias("a"), mixed.alias("b")
    apart = (F.col("a.col") == F.col("b.col")) & (F.col("a.node") < F.col("b.node")) & (F.col("a.root") != F.col("b.root"))
    rest = one.join(other, apart & _room(percent, "a", "b")).select(*_cell("a", "b")).distinct()
    if tried is not None:
        rest = rest.join(tried, ["a", "b"], "left_anti")
    new = similar(staged(rest, "other-cells"))
    known = new if roots is None else new.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b")))
    roots = components(known)

    # Tables that are written first make joins of two tables, which may be split where they are skewed.
    tied = classes.join(roots, "node", "left").select("d1", "d2", F.coalesce("root", "node").alias("class_root"))
    tied = staged(tied, "class-roots")
    own = members.join(tied, ["d1", "d2"], "left").withColumn("root", F.coalesce("class_root", "node"))
    # Texts without words share a digest but not a component.
    own = staged(own.select("key", "n", F.when(F.col("n") > 0, F.col("root")).alias("root")), "members")
    least = staged(own.filter("n > 0").groupBy("root").agg(F.min("key").alias("component_id")), "component-keys")
    out = own.join(least, "root", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("key")).alias("component_id")
    return out.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), component)


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 4, percent: int = 85) -> DataFrame:
    """The rows of ``docs`` that stay when each component keeps the row with its smallest key.

    Of several rows with that key one stays. Rows with a NULL key stay: nothing tells them apart.
    """
    groups = similar_groups(docs, key, text, width, percent)
    own = free_name("_gone", docs.columns)
    keys = groups.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.count(F.lit(1)).alias("rows"), F.max((F.col(key) != F.col("component_id")).cast("int")).alias("gone")
    )
    told = staged(keys.filter("gone = 1 or rows > 1").select(F.col(key).alias(own), "gone"), "group-rows")
    gone = small_or_plain(told.filter("gone = 1").select(own), _SMALL)
    stay = docs.join(gone, docs[key] == gone[own], "left_anti")
    several = told.filter("gone = 0").select(own)
    if several.isEmpty():
        return stay
    alone = stay.join(several, stay[key] == several[own], "left_anti")
    twice = stay.join(several, stay[key] == several[own], "left_semi").dropDuplicates([key])
    return alone.unionByName(twice).select(*quoted(docs.columns))
