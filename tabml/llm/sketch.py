"""Document fingerprints as invertible Bloom lookup sketches, in DataFrame expressions only.

A text is the set of its paragraphs' digests: lines, cut every ``_WORDS`` words, and in texts of up to ``_SHORT``
characters after every word that ends in one of ``_LAST`` as well, so that short texts have several. Its sketch
has ``cells`` cells in three equal tables; each digest goes to one cell of each table, and
a cell holds how many it got, the XOR of them, and the XOR of their check hashes. The
fingerprint is the number of paragraphs and the cells as text.

Two sketches of the same size subtract cell by cell: digests of both texts cancel. Peeling
takes a cell that holds a single digest (the check hash tells), counts that digest as a
difference, and removes it from its other cells, until nothing is left. If cells remain, the
difference is too large for the sketch, and it is built and peeled again with more cells.
The likeness of two texts is the share of their distinct paragraphs that they have in common, from
the numbers of paragraphs and of recovered differences.

Peeling runs as grouping of (pair, cell) rows that stay in the partition of their pair. A
table is peeled at a time, and a digest has one cell in each table, so no digest is removed
twice. Pairs never meet other pairs: nothing grows with groups of copies.

Results for odd input: NULL and empty texts have no paragraphs; two texts without
any have likeness 1, one with and one without likeness 0; white space at the end of a
paragraph and blank lines don't count; texts of any length are sketched whole; repeated rows are rows of their
own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabml.llm.frames import partitions
from tabml.session import staged

_WORDS, _SHORT = 32, 600
_LAST = "[.,;:!?dgi07]"  # in a short text a word that ends so ends its paragraph
CELLS = 12  # of the fingerprint
_TABLES = 3
_CHECK = 77
_PART_CELLS = 500_000  # cells that one task peels
_PEELS = 9  # peels in one job: three of each table


def paragraphs(text: Column) -> Column:
    """Digests of the distinct paragraphs; texts of up to ``_SHORT`` characters are cut more finely."""
    fine = rf"(?:\S++(?<!{_LAST})[^\S\n]++){{0,{_WORDS - 1}}}+(?:\S++[^\S\n]*+)?"
    coarse = rf"(?:\S++[^\S\n]*+){{1,{_WORDS}}}+"
    found = F.when(F.char_length(text) <= _SHORT, F.regexp_extract_all(text, F.lit(fine), F.lit(0))).otherwise(
        F.regexp_extract_all(text, F.lit(coarse), F.lit(0))
    )
    # Not ``F.rtrim`` itself: it takes a second argument, which would be the place in the list.
    found = F.filter(F.transform(found, lambda p: F.rtrim(p)), lambda p: p != "")
    return F.array_distinct(F.transform(found, lambda p: F.xxhash64(p)))


def _place(digest: Column, table: int, cells: Column) -> Column:
    """The cell of a digest in one of the tables."""
    width = cells / _TABLES
    return (F.pmod(F.xxhash64(F.lit(table), digest), width.cast("long")) + table * width.cast("long")).cast("int")


def _check(digest: Column) -> Column:
    return F.xxhash64(F.lit(_CHECK), digest)


def sketch(digests: Column, cells: int = CELLS) -> Column:
    """array<struct<n, x, h>>: count, XOR of digests and XOR of their checks, by cell."""
    width = cells // _TABLES
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("x"), F.lit(0).cast("long").alias("h"))

    def placed(d: Column) -> Column:
        places = [_place(d, t, F.lit(cells)).alias(f"p{t}") for t in range(_TABLES)]
        return F.struct(d.alias("x"), _check(d).alias("h"), *places)

    def cell(every: Column, number: int) -> Column:
        own = F.filter(every, lambda d: d[f"p{number // width}"] == number)
        return F.aggregate(
            own, zero, lambda s, d: F.struct((s["n"] + 1).alias("n"), s["x"].bitwiseXOR(d["x"]).alias("x"), s["h"].bitwiseXOR(d["h"]).alias("h"))
        )

    # Every digest is placed once, in a list of one element that all cells look at.
    once = F.array(F.transform(digests, placed))
    return F.get(F.transform(once, lambda every: F.array(*[cell(every, i) for i in range(cells)])), F.lit(0))


def fingerprint(digests: Column) -> Column:
    """Number of paragraphs, then the cells of their sketch, as text."""
    one = F.transform(sketch(digests), lambda c: F.concat_ws(":", c["n"], F.hex(c["x"]), F.hex(c["h"])))
    return F.concat_ws(",", F.size(digests), F.array_join(one, ","))


# ---------------------------------------------------------------- peeling


def _peeled(state: DataFrame) -> DataFrame:
    """``state`` (pair, kind, cells, cell, n, x, h) after ``_PEELS`` peels; found differences in cell -1."""
    group = ["pair", "kind", "cells", "cell"]
    for i in range(_PEELS):
        table = i % _TABLES
        width = (F.col("cells") / _TABLES).cast("int")
        pure = (F.floor(F.col("cell") / width) == table) & (F.abs("n") == 1) & (F.col("h") == _check(F.col("x")))

        def row(cell: Column, n: Column, x: Column, h: Column) -> Column:
            return F.struct(
                cell.cast("int").alias("cell"), n.cast("long").alias("n"), x.cast("long").alias("x"), h.cast("long").alias("h")
            )

        self_ = row(F.col("cell"), F.col("n"), F.col("x"), F.col("h"))
        taken = [row(_place(F.col("x"), t, F.col("cells")), -F.col("n"), F.col("x"), F.col("h")) for t in range(_TABLES)]
        count = row(F.lit(-1), F.lit(1), F.lit(0), F.lit(0))
        parts = F.when((F.col("cell") >= 0) & pure, F.array(self_, *taken, count)).otherwise(F.array(self_))
        state = state.select("pair", "kind", "cells", F.explode(parts).alias("c")).select("pair", "kind", "cells", "c.*")
        state = state.groupBy(*group).agg(F.sum("n").alias("n"), F.bit_xor("x").alias("x"), F.bit_xor("h").alias("h"))
        state = state.filter("n <> 0 or x <> 0 or h <> 0")
    return state


def _subtracted(pairs: DataFrame) -> DataFrame:
    """Cells of the difference of the sketches of ``one`` and ``other`` (digest arrays)."""

    def signed(name: str, sign: int) -> Column:
        return F.transform(name, lambda d: F.struct(F.lit(sign).alias("n"), d.alias("x")))

    digests = pairs.select("pair", "kind", "cells", F.explode(F.concat(signed("one", 1), signed("other", -1))).alias("d"))
    places = F.array(*[_place(F.col("d.x"), t, F.col("cells")) for t in range(_TABLES)])
    cells = digests.select("pair", "kind", "cells", "d.n", "d.x", F.explode(places).alias("cell"))
    total = cells.groupBy("pair", "kind", "cells", "cell").agg(
        F.sum("n").alias("n"), F.bit_xor("x").alias("x"), F.bit_xor(_check(F.col("x"))).alias("h")
    )
    return total.filter("n <> 0 or x <> 0 or h <> 0")


def _outcome(state: DataFrame) -> DataFrame:
    """(pair, kind, differences, done) of peeled cells."""
    return state.groupBy("pair", "kind").agg(
        F.coalesce(F.sum(F.when(F.col("cell") < 0, F.col("n"))), F.lit(0)).alias("differences"),
        (F.count(F.when(F.col("cell") >= 0, 1)) == 0).alias("done"),
    )


def _enough(squares: Column) -> Column:
    """Cells for a difference estimated from the squared counts of a sketch: each digest adds 1 per table."""
    need = squares / _TABLES * 2 + 12
    return (F.pow(F.lit(2.0), F.ceil(F.log2(need / CELLS))) * 2 * CELLS).cast("int")


def differences(rows: DataFrame, sides: dict[str, tuple[str, str]]) -> DataFrame:
    """(pair, a column for each named side): how many digests differ between two columns of ``rows``.

    The first try subtracts the fingerprints' cells; a pair that they can't hold, by the size
    of its counts or because peeling leaves cells, is tried again with more, until every pair
    is peeled. A row's digests move once per try, and only where a try is due.
    """

    def less(a: str, b: str) -> Column:
        return F.zip_with(
            sketch(F.col(a)),
            sketch(F.col(b)),
            lambda p, q: F.struct(
                (p["n"] - q["n"]).cast("long").alias("n"),
                p["x"].bitwiseXOR(q["x"]).alias("x"),
                p["h"].bitwiseXOR(q["h"]).alias("h"),
            ),
        )

    each = F.array(*[F.struct(F.lit(k).alias("kind"), less(a, b).alias("less")) for k, (a, b) in sides.items()])
    pairs = rows.select("pair", F.explode(each).alias("p")).select("pair", "p.*")
    squares = F.aggregate("less", F.lit(0).cast("long"), lambda s, c: s + c["n"] * c["n"])
    pairs = pairs.withColumn("squares", squares)
    large = F.col("squares") > 2 * CELLS
    pairs = pairs.withColumn("less", F.when(~large, F.col("less")))
    pairs = staged(pairs.withColumn("cells", F.when(large, _enough(F.col("squares"))).otherwise(CELLS)), "sketch-pairs")

    # Small differences: the cells of the fingerprints themselves.
    cells = pairs.filter("less is not null").select("pair", "kind", "cells", F.posexplode("less").alias("cell", "c"))
    state = cells.select("pair", "kind", "cells", "cell", "c.*").filter("n <> 0 or x <> 0 or h <> 0")
    state = state.repartition(partitions(rows.sparkSession), "pair")
    todo, done = pairs.filter("less is not null").select("pair", "kind", "cells"), []
    later = pairs.filter("less is null").select("pair", "kind", "cells")
    while True:
        # A pair without any cell has no difference: all digests cancel.
        tried = todo.join(_outcome(_peeled(state)), ["pair", "kind"], "left").select(
            "pair",
            "kind",
            "cells",
            F.coalesce("differences", F.lit(0)).alias("differences"),
            F.coalesce("done", F.lit(True)).alias("done"),
        )
        tried = staged(tried, "sketch-peeled")
        done.append(tried.filter("done").select("pair", "kind", "differences"))
        todo = tried.filter("not done").select("pair", "kind", (F.col("cells") * 2).alias("cells"))
        if later is not None:
            todo, later = todo.unionByName(later), None
        if todo.isEmpty():
            break
        wide = todo.groupBy("pair").agg(*[F.max(F.when(F.col("kind") == k, F.col("cells"))).alias(f"size_{k}") for k in sides])
        # Cells are many times the shuffled digests: partitions by their number.
        total = todo.agg(F.sum("cells")).first()[0]
        count = max(partitions(rows.sparkSession), total // _PART_CELLS)
        digests = rows.select("pair", *sorted({c for s in sides.values() for c in s}))
        both = digests.repartition(count, "pair").join(wide.repartition(count, "pair"), "pair")
        each = [
            F.struct(F.lit(k).alias("kind"), F.col(f"size_{k}").alias("cells"), F.col(a).alias("one"), F.col(b).alias("other"))
            for k, (a, b) in sides.items()
        ]
        due = both.select("pair", F.explode(F.array(*each)).alias("p")).select("pair", "p.*").filter("cells is not null")
        state = _subtracted(due)
    found = reduce(DataFrame.unionByName, done)
    return found.groupBy("pair").agg(
        *[F.max(F.when(F.col("kind") == k, F.col("differences"))).alias(k) for k in sides]
    )


def likeness(one: Column, other: Column, different: Column) -> Column:
    """Shared paragraphs over distinct paragraphs, from two set sizes and their difference."""
    total = one + other
    return F.when(total == 0, F.lit(1.0)).otherwise((total - different) / (total + different)).cast("double")


# ---------------------------------------------------------------- following documents


def _coarse(rows: DataFrame, key: str) -> Column:
    """A number that never falls as the key rises: the key itself as a double, or, of text, the six bytes
    after what all keys begin with."""
    kind = rows.schema[key].dataType
    if isinstance(kind, T.NumericType):
        return F.col(key).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.col(key).cast("timestamp").cast("double")
    code = F.hex(F.col(key).cast("string").cast("binary"))
    low, high = rows.agg(F.min(code), F.max(code)).first()
    same = 0
    while low and same < min(len(low), len(high)) and low[same] == high[same]:
        same += 1
    after = F.rpad(F.substring(code, same // 2 * 2 + 1, 12), 12, "0")
    return F.when(F.col(key).isNotNull(), F.conv(after, 16, 10).cast("double"))


def with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text, next_text): each row with the text of the row after it by descending key.

    Keys may be numbers of any size, texts (by their bytes) or times. The last row is followed by the first. NULL
    keys come last, rows with equal keys in order of a hash of their text; other columns are ignored. Rows are
    cut into buckets of neighbouring keys at approximate quantiles of a number that follows the key; the order
    within is that of the key itself. The first row of each bucket is also copied to the bucket before it, so
    every row meets its follower in one shuffle of the texts. Keys have to tell rows apart for buckets to
    be even.
    """
    spark = docs.sparkSession
    buckets = 4 * partitions(spark)
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("place", F.coalesce(_coarse(rows, "key"), F.lit(float("-inf"))))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    shares = F.lit([i / buckets for i in range(1, buckets)])
    finite = rows.filter("place > double('-infinity')")
    cuts = finite.agg(F.percentile_approx("place", shares, 20 * buckets)).first()[0] or []
    cuts = sorted(set(cuts), reverse=True)  # one number per bucket
    # Two short searches instead of one over all cuts.
    step = max(1, int(len(cuts) ** 0.5))
    table = F.lit([float(c) for c in cuts]) if cuts else F.array().cast("array<double>")
    coarse = F.lit([float(c) for c in cuts[::step]]) if cuts else F.array().cast("array<double>")
    above = F.greatest(F.size(F.filter(coarse, lambda c: c > F.col("place"))) - 1, F.lit(0)) * step
    within = F.size(F.filter(F.slice(table, above + 1, step), lambda c: c > F.col("place")))
    rows = rows.withColumn("bucket", (above + within).cast("int"))

    # One row per bucket: its first by descending key. The order is the same as in the window below.
    highest = F.max(F.struct("key", F.bitwise_not("tie").alias("down")))
    heads = staged(rows.groupBy("bucket").agg(highest.alias("h")), "bucket-heads")
    order = Window.orderBy("bucket")  # at most ``buckets`` rows
    before = F.coalesce(F.lag("bucket").over(order), F.max("bucket").over(Window.partitionBy()))
    heads = heads.select(F.col("h.key").alias("head"), F.bitwise_not("h.down").alias("head_tie"), before.alias("to"))
    texts = rows.select("key", "tie", "text").join(
        F.broadcast(heads), F.col("key").eqNullSafe(F.col("head")) & (F.col("tie") == F.col("head_tie"))
    )
    copies = texts.select("key", "text", "tie", F.col("to").alias("bucket")).dropDuplicates(["key", "tie"])
    # A copy comes after all rows of the bucket before its own.
    both = rows.select("key", "text", "tie", "bucket", F.lit(0).alias("copy"))
    both = both.unionByName(copies.withColumn("copy", F.lit(1)))
    follow = Window.partitionBy("bucket").orderBy("copy", F.col("key").desc_nulls_last(), "tie")
    return both.withColumn("next_text", F.lead("text").over(follow)).filter("copy = 0").select("key", "text", "next_text")


def edited(text: Column, following: Column) -> Column:
    """The last third of the code points replaced by as many of the following text's first, or all."""
    n = F.char_length(text)
    third = F.floor(n / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - third), F.substring(following, F.lit(1), third))


def versions(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited version, and their likenesses.

    One row per row of ``docs``: key, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, different_edited and different_next (recovered differences).
    """
    rows = with_next(docs, key, text)
    rows = rows.withColumn("edited", edited(F.col("text"), F.col("next_text")))
    rows = rows.select(
        "key",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        paragraphs(F.col("text")).alias("own"),
        paragraphs(F.col("edited")).alias("edit"),
        paragraphs(F.col("next_text")).alias("next"),
    )
    # The numbers are fixed by writing them.
    rows = staged(rows.withColumn("pair", F.monotonically_increasing_id()), "paragraph-digests")
    found = differences(rows, {"different_edited": ("own", "edit"), "different_next": ("own", "next")})
    slim = rows.select(
        "pair",
        "key",
        "n_chars",
        "edited_sha256",
        fingerprint(F.col("own")).alias("fingerprint"),
        fingerprint(F.col("edit")).alias("edited_fingerprint"),
        *[F.size(c).alias(f"n_{c}") for c in ("own", "edit", "next")],
    )
    return slim.join(found, "pair", "left").select(
        F.col("key").alias(key),
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("n_own"), F.col("n_edit"), F.col("different_edited")).alias("near_edited"),
        likeness(F.col("n_own"), F.col("n_next"), F.col("different_next")).alias("near_next"),
        "different_edited",
        "different_next",
    )
