"""Mixing sources to target weights along a time-varying curriculum, in DataFrame expressions.

Targets: sources in code point order weigh 1, 2, 3, repeating, and share the words of all
documents; a target stops at ``most_passes`` times its source's size and the excess is
shared by weight among the others, until none is above.

Curriculum: each source has a weight schedule over training time 0..1, a line through
``knots``. Its integral is the source's cumulative demand. A source's documents stand in
a fixed pseudo-random order, once per pass; the words before a document's middle are the
cumulative supply at which it is due, and the time when the demand reaches it is its
training position. Range-sorting by position gives the training order.

Words before a document are exact running sums: documents are cut into buckets by the first
bits of their order digest, sums run inside (source, bucket), and bucket totals are
added. A source that holds most rows is as many buckets as its rows need. Everything
depends on keys and sizes only, so reruns agree.

Results for odd input: NULL text has size 0; documents of size 0 are passed on but take no
words; NULL sources are one source, the last; NULL and repeated keys order by their text's digest; repeated
rows are documents of their own; texts of any length are counted whole; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabml.llm.frames import free_name, quoted, small_or_plain
from tabml.session import staged

WORD = r"[^\x20\x09-\x0D]+"
# Weight over time by source weight: (time, weight) knots, straight lines between.
SCHEDULES = {
    1: [(0.0, 1.5), (0.5, 1.0), (1.0, 0.5)],
    2: [(0.0, 1.0), (1.0, 1.0)],
    3: [(0.0, 0.5), (0.5, 1.0), (1.0, 1.5)],
}
_BUCKET_ROWS = 1_000


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, most_passes: int = 3, cycle: int = 3) -> DataFrame:
    """``sources`` (source, source_size) with ``weight`` and ``target``.

    One row per source. The common share per weight is found by a few sums over the sources:
    each round fixes those at their limit, until no other goes above it.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    ranked = staged(sources.withColumn("weight", (place - 1) % cycle + 1), "mix-sources")
    most = F.col("source_size") * most_passes
    share, fixed = 0.0, -1
    while True:
        full = most <= F.lit(share) * F.col("weight")
        total, held, free, n = ranked.agg(
            F.coalesce(F.sum("source_size"), F.lit(0)),
            F.coalesce(F.sum(F.when(full, most)), F.lit(0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)),
            F.count(F.when(full, 1)),
        ).first()
        if n == fixed or not free:
            break
        share, fixed = (total - held) / free, n
    return ranked.withColumn("target", F.when(full, most).otherwise(F.lit(share) * F.col("weight")).cast("double"))


def time_of(done: Column, knots: list[tuple[float, float]]) -> Column:
    """Training time at which a source with this schedule has met the share ``done`` of its demand."""
    areas = [(t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:])]
    whole, before, out = sum(areas), 0.0, None
    for (t0, w0), (t1, w1), area in zip(knots, knots[1:], areas):
        need = F.greatest(done * whole - before, F.lit(0.0))  # area within this stretch
        slope = (w1 - w0) / (t1 - t0)
        if abs(slope) < 1e-12:
            local = need / w0
        else:
            # w0 x + slope x^2 / 2 = need
            local = (F.sqrt(F.greatest(F.lit(w0 * w0) + 2 * slope * need, F.lit(0.0))) - w0) / slope
        at = F.lit(t0) + F.least(local, F.lit(t1 - t0))
        upto = (before + area) / whole
        out = F.when(done <= upto, at) if out is None else out.when(done <= upto, at)
        before += area
    return out.otherwise(F.lit(knots[-1][0]))


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    most_passes: int = 3,
    schedules: dict[int, list[tuple[float, float]]] = SCHEDULES,
    seed: str = "mix",
    extra: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per document: key, source, size, source_size, target, taken, positions.

    ``positions`` are the training positions (in words) of the passes that take the
    document, ascending; ``taken`` is their number times the size. ``extra`` adds columns
    computed from ``docs``.
    """
    extra = extra or {}
    # The digest, and so the order, hangs on the key and the text: rows without a key, or with the same one,
    # spread over the buckets like others. Ties are broken by size.
    content = F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))
    draw = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("null")), F.lit(":"), content))
    sized = docs.select(
        F.col(key).alias("key"),
        F.col(source).alias("source"),
        n_words(F.col(text)).alias("size"),
        draw.alias("draw"),
        *[c.alias(n) for n, c in extra.items()],
    )
    sized = staged(sized, "mix-sizes")
    rows = sized.count()
    bits = min(max(rows // _BUCKET_ROWS, 1).bit_length() - 1, 24)
    # Plain equality needs a source that is never NULL.
    name = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null"))
    bucket = F.shiftright(F.conv(F.substring("draw", 1, 6), 16, 10).cast("long"), 24 - bits)
    sized = sized.withColumn("_source", name).withColumn("_bucket", bucket)

    order = Window.partitionBy("_source", "_bucket").orderBy("draw", "size", "key")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = sized.withColumn("_inside", F.sum("size").over(upto))

    buckets = sized.groupBy("_source", "_bucket").agg(F.sum("size").alias("_n"))
    before = Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = buckets.select("_source", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))

    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    goal = targets(totals, most_passes)
    goal = goal.select(F.coalesce(F.concat(F.lit("="), "source"), F.lit("null")).alias("_source"), "source_size", "weight", "target")
    # One row a source: broadcast where they are few.
    found = inside.join(offsets, ["_source", "_bucket"]).join(small_or_plain(goal, 100_000), "_source")

    size, whole, target = F.col("size"), F.col("source_size"), F.col("target")
    middle = F.col("_before") + F.col("_inside") - size / 2
    passes = F.when(whole > 0, F.floor(target / whole)).otherwise(F.lit(0)).cast("int")
    found = found.withColumn("_middle", middle).withColumn("_full", passes)
    more = (F.col("_middle") < target - F.col("_full") * whole).cast("int")
    found = found.withColumn("_passes", F.col("_full") + more)
    all_words = F.lit(float(totals.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]))

    def position(turn: Column) -> Column:
        done = F.least(F.when(target > 0, (turn * whole + F.col("_middle")) / target).otherwise(F.lit(0.0)), F.lit(1.0))
        cycle = F.pmod(F.col("weight") - 1, F.lit(len(schedules))) + 1
        at = F.lit(0.0)
        for weight, knots in schedules.items():
            at = F.when(cycle == weight, time_of(done, knots)).otherwise(at)
        return at * all_words

    turns = F.when(F.col("_passes") > 0, F.sequence(F.lit(0), F.col("_passes") - 1))
    positions = F.coalesce(F.transform(turns, position), F.array().cast("array<double>"))
    return found.select(
        F.col("key").alias(key),
        "source",
        "size",
        "source_size",
        "target",
        (size * F.col("_passes")).alias("taken"),
        positions.alias("positions"),
        *extra,
    )


def in_training_order(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The documents of the mix, once per pass that takes them, range-sorted by position.

    The columns are those of ``docs``. Equal rows are told apart by number, so each gets the
    positions of one of them.
    """
    columns = docs.columns
    # Names that no column of the documents has.
    own = {n: free_name(n, columns) for n in ("_row", "_copy", "_at", "_position")}
    identity = F.xxhash64(F.col(f"`{key}`").cast("string"), F.col(f"`{source}`"), F.col(f"`{text}`"))
    plan = mix(docs, key, text, source, extra={own["_row"]: identity}, **options)
    numbered = Window.partitionBy(own["_row"])
    plan = plan.select(
        own["_row"],
        F.row_number().over(numbered.orderBy("positions")).alias(own["_copy"]),
        F.col("positions").alias(own["_at"]),
    )
    rows = docs.withColumn(own["_row"], identity)
    rows = rows.withColumn(own["_copy"], F.row_number().over(numbered.orderBy(own["_row"])))
    joined = rows.join(plan, [own["_row"], own["_copy"]])
    turns = joined.select(*quoted(columns), own["_row"], F.explode(own["_at"]).alias(own["_position"]))
    return turns.orderBy(own["_position"], own["_row"]).select(*quoted(columns))

