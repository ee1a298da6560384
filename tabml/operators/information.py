"""Mutual information of numbers with classes by nearest neighbours in one dimension.

For each value: the distance r to the ``k``-th nearest other value of its class, then how many
values of any class lie within less than r. The estimate is psi(N) + mean psi(k) - mean psi(class size) -
mean psi(values within r), not below 0; classes of one value are left out. No pair of rows is compared:
values become whole numbers (standardised, a millionth of a deviation each, plus a jitter from
the row's digest that parts ties), so counts by value, ranks within the class and counts up to a value come
from bucketed running totals; the ``k`` neighbours on either side come from windows over blocks of ranks that
share their edges, equally large whatever class or value dominates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabml.functions.ordered import counted_upto, running_totals
from tabml.functions.scalars import hash_fraction, hash_order
from tabml.session import staged

STEP = 1_000_000
BLOCK = 2_000


def digamma(x: Column) -> Column:
    """psi of a whole number from 1 on: the asymptotic series at x + 6, and back by recurrence."""
    x = x.cast("double")
    t = x + 6
    series = F.log(t) - 1 / (2 * t) - 1 / (12 * t * t) + 1 / (120 * t * t * t * t) - 1 / (252 * t * t * t * t * t * t)
    for i in range(6):
        series = series - 1 / (x + i)
    return series


def neighbour_information(df: DataFrame, numeric: list[str], target: str, k: int = 3, key: tuple[str, ...] = ()) -> DataFrame:
    """(column, mutual_information) in nats; NULL with fewer than 20 usable pairs.

    ``key`` names the columns whose digest parts equal values (all columns by default); rows that
    agree in it as well stay together and count as often as they occur. NULL and NaN are left out.
    """
    known = df.filter(F.col(target).isNotNull())
    jitter = F.floor(hash_fraction(hash_order(*[F.col(f"`{c}`") for c in key or df.columns])) * STEP)
    rows = known.select(F.col(target).cast("string").alias("y"), jitter.alias("jitter"), *[F.col(f"`{c}`") for c in numeric])
    # Columns travel as small numbers.
    pairs = [F.struct(F.lit(i).alias("column"), F.col(f"`{c}`").cast("double").alias("value")) for i, c in enumerate(numeric)]
    long = rows.select("y", "jitter", F.explode(F.array(*pairs)).alias("p")).select("y", "jitter", "p.column", "p.value")
    long = long.filter("value is not null and not isnan(value)")
    facts = long.groupBy("column").agg(
        F.avg("value").alias("middle"), F.stddev_pop("value").alias("spread")
    )
    # One row a column.
    scaled = long.join(F.broadcast(facts), "column")
    z = (F.col("value") - F.col("middle")) / F.when(F.col("spread") > 0, F.col("spread")).otherwise(F.lit(1.0))
    placed = scaled.select("column", "y", (F.round(z * STEP).cast("long") * STEP + F.col("jitter")).alias("v"))
    counts = staged(placed.groupBy("column", "y", "v").agg(F.count(F.lit(1)).alias("n")), "values")

    # Ranks within the class; of equal values k + 1 are enough to be neighbours.
    some = F.least(F.col("n"), F.lit(k + 1))
    ranks = running_totals(counts, ["column", "y"], "v", {"n": F.col("n"), "c": some}, grouped=True)
    ranks = ranks.filter(F.col("all_n") > 1).select("column", "y", "v", "n", "all_n", F.col("cum_c").alias("last"), "c")
    copies = ranks.withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("c") - 1)))
    copies = copies.withColumn("rank", F.col("last") - F.col("c") + F.col("i"))
    own, inside = F.floor(F.col("rank") / BLOCK), F.pmod(F.col("rank"), F.lit(BLOCK))
    guests = F.array(own, F.when(inside < k, own - 1), F.when(inside >= BLOCK - k, own + 1))
    seats = copies.withColumn("block", F.explode(guests)).filter("block is not null").withColumn("guest", F.col("block") != own)
    order = Window.partitionBy("column", "y", "block").orderBy("rank")
    away = [F.col("v") - F.lag("v", i).over(order) for i in range(1, k + 1)] + [F.lead("v", i).over(order) - F.col("v") for i in range(1, k + 1)]
    # Beyond the ends nothing is near; ``enough`` never reaches so far.
    near = F.sort_array(F.array(*[F.coalesce(a, F.lit((1 << 63) - 1)) for a in away]))
    seats = seats.withColumn("near", near).filter(~F.col("guest") & (F.col("i") == 0))
    enough = F.least(F.lit(k), F.col("all_n") - 1).cast("int")
    points = seats.select("column", "y", "v", "n", "all_n", enough.alias("k"), F.element_at("near", enough).alias("r"))
    points = staged(points, "distances")

    # How many values lie strictly within r: v are whole numbers, so those up to v + r - 1 less those up to v - r.
    point = F.struct("y", "v", "n", "all_n", "k").alias("point")
    far = points.filter("r > 0")
    ends = far.select("column", F.explode(F.array(F.col("v") - F.col("r"), F.col("v") + F.col("r") - 1)).alias("at"), F.lit(0).cast("long").alias("weight"), point)
    held = points.select("column", F.col("v").alias("at"), F.col("n").alias("weight"))
    upto = counted_upto(held.unionByName(ends, allowMissingColumns=True), ["column"], "at", "weight")
    reached = upto.filter("point is not null").groupBy("column", "point.y", "point.v").agg(
        *[F.first(f"point.{c}").alias(c) for c in ("n", "all_n", "k")], (F.max("upto") - F.min("upto")).alias("within")
    )
    # A value whose k-th neighbour is equal to it counts its equals.
    same = points.filter("r = 0")
    equal = counts.join(same.select("column", "v").distinct(), ["column", "v"], "left_semi")
    equal = equal.groupBy("column", "v").agg(F.sum("n").alias("within"))
    found = reached.drop("y").unionByName(same.select("column", "v", "n", "all_n", "k").join(equal, ["column", "v"]))
    within = F.greatest("within", F.lit(1))
    w = F.col("n").cast("double")
    sums = found.groupBy("column").agg(
        F.sum("n").alias("total"),
        F.sum(w * digamma(F.col("k"))).alias("by_k"),
        F.sum(w * digamma(F.col("all_n"))).alias("by_class"),
        F.sum(w * digamma(within)).alias("by_reach"),
    )
    estimate = digamma(F.col("total")) + (F.col("by_k") - F.col("by_class") - F.col("by_reach")) / F.col("total")
    known_columns = df.sparkSession.createDataFrame(list(enumerate(numeric)), "column int, name string")
    return known_columns.join(sums, "column", "left").select(
        F.col("name").alias("column"), F.when(F.col("total") >= 20, F.greatest(estimate, F.lit(0.0))).alias("mutual_information")
    )
