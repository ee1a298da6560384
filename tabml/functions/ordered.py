"""Exact order statistics without a global sort on one task.

``running_totals`` cuts the value range into buckets at approximate quantiles,
sums inside each bucket and adds the totals of the buckets before it. The cuts only
balance the work: results are exact wherever they fall. Equal values are aggregated
before the shuffle, so a value that holds most rows is one row.

``rank_cuts`` finds the key at a given rank by counting ever finer buckets, so rows
are never shuffled; only the last, small bucket is sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabml.session import bounded_rows, staged

_CUTS = 256  # buckets between approximate quantiles, found by a binary search
_PARTS = 16  # equal-width parts inside each bucket, at least
_PART_ROWS = 4_000  # rows that a part is meant for: more rows make more parts


def _cut_tree(df: DataFrame, order: Column) -> Column:
    """Approximate quantiles at 0/256 .. 256/256, and the parts that each bucket is cut into.

    They only balance the buckets, so the sketch that every task sends is kept small.
    """
    shares = F.expr("array(" + ",".join(f"{i / _CUTS}D" for i in range(_CUTS + 1)) + ")")
    cuts = df.agg(F.percentile_approx(order.cast("double"), shares, 1024).alias("q"), F.count(order).alias("n"))
    return cuts.selectExpr(f"struct(q, greatest({_PARTS}L, n div {_CUTS * _PART_ROWS}L) as parts) as t").scalar()


def _bucket(df: DataFrame, tree: str, value: str) -> DataFrame:
    """A bucket number that grows with the value: 8 comparisons and one interpolation.

    Bucket k lies between quantiles k and k + 1 and is cut into equal-width parts.
    """
    v = f"cast(`{value}` as double)"
    # A binary search, one plain expression a step: compiled, unlike a filter over the array.
    df = df.withColumn("_b", F.lit(0))
    step = _CUTS // 2
    while step:
        df = df.withColumn("_b", F.expr(f"_b + if({tree}.q[_b + {step}] < {v}, {step}, 0)"))
        step //= 2
    part = F.expr(
        f"case when {tree}.q[_b + 1] > {tree}.q[_b] then"
        f" least(greatest(floor(({v} - {tree}.q[_b]) / ({tree}.q[_b + 1] - {tree}.q[_b]) * {tree}.parts), 0),"
        f" {tree}.parts - 1) else 0 end"
    )
    # Never NULL, so that a join on it asks for no check of the input rows.
    number = F.coalesce(F.col("_b") * F.col(f"{tree}.parts") + part, F.lit(0))
    return df.withColumn("_bucket", number).drop(tree, "_b")


def balanced_buckets(df: DataFrame, order: str) -> DataFrame:
    """Adds ``_bucket``, which grows with the order column and spreads its rows evenly."""
    return _bucket(df.withColumn("_tree", _cut_tree(df, F.col(order))), "_tree", order)


def _plain_keys(df: DataFrame, by: list[str]) -> tuple[DataFrame, list[str]]:
    """The groups as keys that are never NULL: plain equality keeps the partitioning
    of a window, null-safe equality would shuffle and sort the rows once more."""
    keys = [f"_key{i}" for i in range(len(by))]
    for key, c in zip(keys, by):
        text = F.concat(F.lit("="), F.col(f"`{c}`").cast("string"))
        df = df.withColumn(key, F.coalesce(text, F.lit("null")))
    return df, keys


def counted_upto(df: DataFrame, by: list[str], order: str, weight: str) -> DataFrame:
    """``df`` with ``upto``: the sum of ``weight`` over the rows of the group that are not beyond it in the order.

    ``order`` holds no NULL. Rows stay as they are, so a row of weight 0 asks for the count at its place.
    """
    tagged, keys = _plain_keys(_bucket(df.withColumn("_tree", _cut_tree(df, F.col(order))), "_tree", order), by)
    place = ["_bucket", *keys]  # the bucket first: sorts compare it before any text
    inside = Window.partitionBy(*place).orderBy(order).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = tagged.groupBy(*place).agg(F.sum(weight).alias("_sum"))
    offsets = totals.select(*place, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_off"))
    local = tagged.withColumn("_in", F.sum(weight).over(inside)).join(offsets, place)
    return local.select(*df.columns, (F.col("_in") + F.col("_off")).alias("upto"))


def running_totals(
    df: DataFrame, by: list[str], order: str, sums: dict[str, Column], descending: bool = False, grouped: bool = False
) -> DataFrame:
    """One row per (by, order) with each sum, its running total and its grand total.

    Adds ``<name>``, ``cum_<name>`` (inclusive) and ``all_<name>``. NULL order values
    are left out. ``grouped``: each (by, order) is one row already, and the sums are plain columns.
    """
    df = df.filter(F.col(order).isNotNull())
    values = [c.alias(n) for n, c in sums.items()]
    groups = df.select(*by, order, *values) if grouped else df.groupBy(*by, order).agg(*values)
    # Cuts from the rows themselves: a pass over one column instead of a second grouping.
    tagged = _bucket(groups.withColumn("_tree", _cut_tree(df, F.col(order))), "_tree", order)

    tagged, keys = _plain_keys(tagged, by)
    place = ["_bucket", *keys]  # the bucket first: sorts compare it before any text

    def toward(name: str) -> Column:
        return F.col(name).desc() if descending else F.col(name).asc()

    inside = (
        Window.partitionBy(*place)
        .orderBy(toward(order))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = tagged.select("*", *[F.sum(n).over(inside).alias(f"_in_{n}") for n in sums])

    # A row per bucket and group of ``by``: some thousandth of the rows.
    totals = tagged.groupBy(*place).agg(*[F.sum(n).alias(n) for n in sums])
    scope = Window.partitionBy(*keys)
    before = scope.orderBy(toward("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *place,
        *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_off_{n}") for n in sums],
        *[F.sum(n).over(scope).alias(f"all_{n}") for n in sums],
    )
    # The window above already partitioned and sorted the rows by these join keys.
    return local.join(offsets, place).select(
        *by,
        order,
        *sums,
        *[(F.col(f"_in_{n}") + F.col(f"_off_{n}")).alias(f"cum_{n}") for n in sums],
        *[F.col(f"all_{n}") for n in sums],
    )


def unpivoted(df: DataFrame, columns: list[str], kind: str = "double") -> DataFrame:
    """(column, value) rows, one per input row and column."""
    pairs = [
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").try_cast(kind).alias("value"))
        for c in columns
    ]
    return df.select(F.explode(F.array(*pairs)).alias("p")).select("p.column", "p.value")


def exact_quantiles(df: DataFrame, columns: list[str], shares: dict[str, float]) -> DataFrame:
    """One row per column with the linearly interpolated quantiles; NULLs are ignored."""
    values = unpivoted(df, columns).filter(~F.isnan("value"))
    cum = running_totals(values, ["column"], "value", {"n": F.count(F.lit(1))})

    def at(position: Column) -> Column:
        return F.min(F.when(F.col("cum_n") > position, F.col("value")))

    picks = []
    for name, share in shares.items():
        place = F.lit(float(share)) * (F.col("all_n") - 1)
        picks.append(at(F.floor(place)).alias(f"_lo_{name}"))
        picks.append(at(F.ceil(place)).alias(f"_hi_{name}"))
        picks.append(F.max(place - F.floor(place)).alias(f"_part_{name}"))
    found = cum.groupBy("column").agg(*picks)
    return found.select(
        "column",
        *[
            (F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * F.col(f"_part_{n}")).alias(n)
            for n in shares
        ],
    )


# ---------------------------------------------------------------- ranks

RANGE_ROWS = 500_000


def numbered(df: DataFrame, order: list[str], by: list[str] = (), name: str = "number") -> DataFrame:
    """``df`` with gapless numbers from 0 in that order (per group of ``by``), NULLs first.

    Rows are range-sorted and numbered range by range; what lies before a range is a sum over ranges. Rows
    that agree in the order have different numbers, by their place in the written table, so a key that many
    rows share is many ranges. ``by`` holds few groups, none NULL.
    """
    rows = staged(df.withColumn("_tie", F.monotonically_increasing_id()), "unnumbered")
    keys = [*by, *order, "_tie"]
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // RANGE_ROWS))
    # The id that Spark gives is the partition, shifted, and the row's place in it.
    placed = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
    placed = staged(placed, "numbered").withColumn("_part", F.shiftright("_at", 33))
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row a range: bounded by the number of partitions.
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    out = placed.join(F.broadcast(offsets), "_part").withColumn(name, place).drop("_part", "_at", "_tie", "_before")
    if by:
        first = out.groupBy(*by).agg(F.min(name).alias("_first"))
        out = out.join(F.broadcast(first), list(by)).withColumn(name, F.col(name) - F.col("_first")).drop("_first")
    return out


def digest_levels(digest: Column) -> list[Column]:
    """Two levels of 65,536 buckets for a hex digest, coarse to fine."""
    return [F.substring(digest, 1, 4), F.substring(digest, 5, 4)]


def rank_cuts(
    df: DataFrame,
    label: Column,
    levels: list[Column],
    key: Column,
    targets: list[tuple[object, int]],
    last_bucket: int = 2_000_000,
) -> dict[tuple[object, int], tuple]:
    """For each (label, rank): the ``(*levels, key)`` values of the row at that rank.

    Ranks count from 1 within the label, in the order of ``levels`` and then ``key``.
    The levels have to be coarsenings of the full order, each with a bounded number
    of values below its parent. Every round counts one level in the buckets that hold
    a target and stops as soon as those are small enough to rank directly.
    """
    spark = df.sparkSession
    rows = df.select(
        label.alias("label"), *[c.alias(f"v{i}") for i, c in enumerate(levels)], key.alias("key")
    )
    # Open targets: (label, asked rank, remaining rank, values found so far).
    open_ = [(lab, rank, rank, ()) for lab, rank in targets if rank > 0]
    if not open_:
        return {}
    kinds = {f.name: f.dataType for f in rows.schema.fields}

    def inside(depth: int) -> DataFrame:
        """Rows in the buckets of the open targets, with the target's ranks.

        The targets are a local list of a few rows per label: a safe broadcast.
        """
        schema = T.StructType(
            [T.StructField("label", kinds["label"])]
            + [T.StructField("asked", T.LongType()), T.StructField("rest", T.LongType())]
            + [T.StructField(f"v{i}", kinds[f"v{i}"]) for i in range(depth)]
        )
        local = spark.createDataFrame([(lab, a, r, *vs) for lab, a, r, vs in open_], schema)
        return rows.join(F.broadcast(local), ["label", *[f"v{i}" for i in range(depth)]])

    for depth in range(len(levels)):
        level = f"v{depth}"
        prefix = ["label", "asked", "rest", *[f"v{i}" for i in range(depth)]]
        counts = inside(depth).groupBy(*prefix, level).agg(F.count(F.lit(1)).alias("n"))
        upto = F.sum("n").over(
            Window.partitionBy(*prefix).orderBy(level).rowsBetween(Window.unboundedPreceding, 0)
        )
        hit = (
            counts.withColumn("upto", upto)
            .filter((F.col("upto") >= F.col("rest")) & (F.col("upto") - F.col("n") < F.col("rest")))
            .collect()  # one row per target
        )
        open_ = [
            (r["label"], r["asked"], r["rest"] - (r["upto"] - r["n"]), (*[r[p] for p in prefix[3:]], r[level]))
            for r in hit
        ]
        if sum(r["n"] for r in hit) <= last_bucket:
            break
    depth = len(open_[0][3]) if open_ else 0
    within = ["label", "asked", "rest", *[f"v{i}" for i in range(depth)]]
    rest_levels = [f"v{i}" for i in range(depth, len(levels))]
    rn = F.row_number().over(Window.partitionBy(*within).orderBy(*rest_levels, "key"))
    found = inside(depth).withColumn("rn", rn).filter(F.col("rn") == F.col("rest")).collect()
    order = [*[f"v{i}" for i in range(len(levels))], "key"]
    return {(r["label"], r["asked"]): tuple(r[c] for c in order) for r in found}


def class_sizes(df: DataFrame, label: Column, limit: int = 100_000) -> dict:
    """Rows per label on the driver. A label with more values than ``limit`` is no class."""
    counts = df.groupBy(label.alias("label")).agg(F.count(F.lit(1)).alias("n"))
    return {r["label"]: r["n"] for r in bounded_rows(counts, limit, "classes of the label")}
