"""Data card: dataset summary and one row per column, computed in a few passes.

Plain statistics of all columns come from one aggregation without a shuffle of rows.
Everything that depends on value frequencies (distinct counts, top values, quantiles,
mutual information) comes from (column, value) counts, aggregated on the map side
first, so frequent values cost one row per task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabml.functions.ordered import exact_quantiles, running_totals, unpivoted
from tabml.functions.scalars import finite
from tabml.session import staged

# Fixed value: names that look like identifiers, in any case.
ID_PATTERN = r"(_ID$|^ID$|ID_)"
SHORT = 40  # characters of a text that is compared as it is
QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


@dataclass(frozen=True)
class ProfileOptions:
    target: str | None = None
    id_column: str | None = None
    task: str | None = None
    top_k: int = 10
    max_unique_ratio: float = 0.5
    id_pattern: str = ID_PATTERN
    text_min_length: float = 20.0
    suspected_id_ratio: float = 0.9
    max_columns: int | None = None


def _kind(field: T.StructField) -> str:
    if isinstance(field.dataType, T.BooleanType):
        return "bool"
    if isinstance(field.dataType, T.NumericType):
        return "number"
    if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "time"
    return "string"


def kinds(df: DataFrame) -> dict[str, str]:
    return {f.name: _kind(f) for f in df.schema.fields}


def numeric_columns(df: DataFrame) -> list[str]:
    return [c for c, k in kinds(df).items() if k == "number"]


def without_nan(df: DataFrame) -> DataFrame:
    """NaN counts as missing everywhere, so it becomes NULL at the door."""
    floats = {
        f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }
    return df.select(
        *[
            F.when(~F.isnan(f"`{c}`"), F.col(f"`{c}`")).alias(c) if c in floats else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def first_columns(df: DataFrame, limit: int | None = None) -> DataFrame:
    return df if limit is None else df.select(*[f"`{c}`" for c in df.columns[:limit]])


# ---------------------------------------------------------------- dataset level


def row_digest(df: DataFrame) -> Column:
    """Digest of all values of a row; NULL and the empty text differ."""
    text = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in df.columns]
    marks = [F.col(f"`{c}`").isNull().cast("int").cast("string") for c in df.columns]
    lengths = [F.length(t).cast("string") for t in text]
    return F.md5(F.concat_ws("|", *marks, *lengths, *text))


def dataset_summary(df: DataFrame) -> DataFrame:
    """Rows, columns and share of duplicate rows.

    Rows are compared by a digest of all their values, so the shuffle moves 32
    characters per distinct row and not the row.
    """
    groups = df.groupBy(row_digest(df).alias("digest")).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.lit(len(df.columns)).alias("n_cols"),
        F.round(
            100.0 * (1.0 - F.count(F.lit(1)) / F.greatest(F.sum("n"), F.lit(1))), 4
        ).alias("dup_row_pct"),
    )


# ---------------------------------------------------------------- frequencies


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, n) with values as text; NULL is a value."""
    return (
        unpivoted(df, columns, "string")
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def top_values(df: DataFrame, columns: list[str], k: int = 10, with_nulls: bool = True) -> DataFrame:
    """The k most frequent values per column; ties in value order, NULL last."""
    counts = value_counts(df, columns)
    if not with_nulls:
        counts = counts.filter(F.col("value").isNotNull())
    order = Window.partitionBy("column").orderBy(F.desc("n"), F.asc_nulls_last("value"))
    ranked = counts.withColumn("place", F.row_number().over(order))
    return ranked.filter(F.col("place") <= k)


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct non-null values per column, and whether they all read as 0 or 1.

    Values are compared whole: numbers as numbers, others as texts, long ones by their digest.
    """
    entries = [F.struct(F.lit(i).alias("place"), *_identity(df, c)) for i, c in enumerate(columns)]
    values = df.select(F.explode(F.array(*entries)).alias("e")).select("e.*").filter(
        "whole is not null or number is not null or short is not null or digest is not null"
    )
    # A row per value; only then is it looked at. Columns travel as small numbers.
    found = values.groupBy("place", "whole", "number", "minus", "short", "digest").agg(F.bool_and("zero_one").alias("zero_one"))
    number = F.coalesce(F.col("whole").cast("double"), "number", F.col("short").try_cast("double"))
    zero_one = F.coalesce((number > -1) & (number < 2), "zero_one", F.lit(True))
    found = found.groupBy("place").agg(F.count(F.lit(1)).alias("n_unique"), F.bool_and(zero_one).alias("zero_one"))
    names = F.array(*[F.lit(c) for c in columns])
    return found.select(F.get(names, F.col("place")).alias("column"), "n_unique", "zero_one")


def _identity(df: DataFrame, name: str) -> list[Column]:
    """What tells a column's values apart: whole numbers as they are, fractions with the sign of zero, all else
    as text, beyond ``SHORT`` characters by its digest, and only then is ``zero_one`` known at once."""
    col, kind = F.col(f"`{name}`"), df.schema[name].dataType
    whole, number, minus, short, digest, zero_one = (F.lit(None).cast(t) for t in ("long", "double", "boolean", "string", "binary", "boolean"))
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        whole = col.cast("long")
    elif isinstance(kind, (T.DoubleType, T.FloatType)):
        number = col.cast("double")
        minus = F.when(number == 0, number.cast("string") == "-0.0")
    else:
        text = col.cast("string")
        read, long = text.try_cast("double"), F.length(text) > SHORT
        short, digest = F.when(~long, text), F.when(long, F.unhex(F.md5(text)))
        zero_one = F.when(long, F.coalesce((read > -1) & (read < 2), F.lit(True)))
    parts = {"whole": whole, "number": number, "minus": minus, "short": short, "digest": digest, "zero_one": zero_one}
    return [c.alias(n) for n, c in parts.items()]


# ---------------------------------------------------------------- columns


def column_stats(df: DataFrame) -> DataFrame:
    """One row per column: type, counts, range, mean, sample deviation, mean text length."""
    df = without_nan(df)
    entries = []
    for name, kind in kinds(df).items():
        col = F.col(f"`{name}`")
        number = col.cast("double") if kind == "number" else F.lit(None).cast("double")
        time = col.cast("timestamp") if kind == "time" else F.lit(None).cast("timestamp")
        text = F.length(col) if kind == "string" else F.lit(None).cast("int")
        dtype = df.schema[name].dataType.simpleString()
        entries.append(
            F.struct(
                F.lit(name).alias("column"),
                F.lit(dtype).alias("dtype"),
                F.lit(kind).alias("kind"),
                F.count(F.lit(1)).alias("n_rows"),
                F.count(col).alias("non_null"),
                (F.count(F.lit(1)) - F.count(col)).alias("nulls"),
                F.min(number).alias("min"),
                F.max(number).alias("max"),
                F.avg(number).alias("mean"),
                F.stddev_samp(number).alias("std"),
                F.min(time).alias("min_time"),
                F.max(time).alias("max_time"),
                F.avg(text).alias("mean_length"),
            )
        )
    return df.agg(F.array(*entries).alias("all")).select(F.inline("all"))


def _share(top: Column, rows: Column) -> Column:
    return top.cast("double") / F.greatest(rows, F.lit(1))


def column_profile(df: DataFrame, opts: ProfileOptions = ProfileOptions()) -> DataFrame:
    """``column_stats`` with distinct counts, flags, logical type, role and id suspicion."""
    df = without_nan(first_columns(df, opts.max_columns))
    stats = column_stats(df).join(distinct_counts(df, df.columns), "column", "left")
    unique = F.coalesce("n_unique", F.lit(0))
    rows = F.col("n_rows")
    stats = stats.withColumn("n_unique", unique).withColumn(
        "unique_ratio", F.round(_share(F.col("n_unique"), rows), 6)
    )
    boolish = (F.col("kind") == "bool") | (
        (F.col("n_unique") <= 2) & F.coalesce("zero_one", F.lit(True))
    )
    named = F.col("column").rlike("(?i)" + opts.id_pattern)
    if opts.id_column:
        named = named | (F.col("column") == opts.id_column)
    inferred = (
        F.when(named, "id")
        .when(F.col("kind") == "time", "datetime")
        .when(boolish, "boolean")
        .when(F.col("kind") == "number", "numeric")
        .when(F.col("mean_length") >= opts.text_min_length, "text")
        .otherwise("categorical")
    )
    role = F.when(F.col("column") == F.lit(opts.target or ""), "target")
    if opts.id_column:
        role = role.when(F.col("column") == opts.id_column, "id")
    raw_ratio = _share(F.col("n_unique"), rows)
    return stats.select(
        "*",
        F.round(100.0 * _share(F.col("nulls"), rows), 4).alias("missing_pct"),
        (F.col("n_unique") <= 1).alias("constant"),
        (raw_ratio > opts.max_unique_ratio).alias("high_cardinality"),
        inferred.alias("inferred_type"),
        role.otherwise("feature").alias("role"),
        (
            (inferred == "id")
            | ((F.col("kind") == "string") & (raw_ratio > opts.suspected_id_ratio))
        ).alias("suspected_id"),
    ).drop("zero_one")


def coverage_days(low: Column, high: Column) -> Column:
    """Whole elapsed days; calendar days would count midnights instead."""
    return F.floor((F.unix_seconds(high) - F.unix_seconds(low)) / 86400)


def time_coverage(df: DataFrame) -> DataFrame:
    stats = column_stats(df).filter("kind = 'time'")
    return stats.select(
        "column",
        "min_time",
        "max_time",
        coverage_days(F.col("min_time"), F.col("max_time")).alias("coverage_days"),
    )


def numeric_summary(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mean, deviation, extremes and exact interpolated quartiles per column."""
    df = without_nan(df.select(*columns))
    stats = column_stats(df).select("column", "mean", "std", "min", "max")
    return stats.join(exact_quantiles(df, columns, QUARTILES), "column", "left")


# ---------------------------------------------------------------- target


def target_summary(df: DataFrame, target: str, task: str | None = None) -> DataFrame:
    """One row per class with its count, and the task, ratio and positive class.

    1, "1" or true is the positive class if present, else the rarest one. A numeric target
    (``task`` begins with regress) has no classes: one row with the number of known values.
    """
    if str(task or "").startswith("regress"):
        return df.agg(
            F.lit(None).cast("string").alias("class"),
            F.count(F.col(target)).alias("n"),
            F.lit("regression").alias("task"),
            F.lit(None).cast("string").alias("positive_class"),
            F.lit(None).cast("double").alias("imbalance_ratio"),
        )
    counts = (
        df.groupBy(F.col(target).cast("string").alias("class")).agg(F.count(F.lit(1)).alias("n"))
    )
    lowered = F.lower("class")
    likely = F.when(F.col("class") == "1", 0).when(lowered == "true", 1).otherwise(2)
    total = counts.agg(
        F.count("class").alias("classes"),
        F.count(F.lit(1)).alias("groups"),
        F.max("n").alias("major"),
        F.min("n").alias("minor"),
        F.min(F.struct(likely.alias("a"), F.col("n").alias("b"), F.col("class").alias("c"))).alias("p"),
    )
    # A single row: the totals over the classes.
    facts = total.select(
        F.struct(
            F.when(F.col("classes") <= 2, "binary")
            .otherwise("multiclass")
            .alias("task"),
            F.when(F.col("classes") == 2, F.col("p.c")).alias("positive_class"),
            F.when(
                F.col("groups") >= 2,
                F.round(F.col("major") / F.greatest(F.col("minor"), F.lit(1)), 4),
            ).alias("imbalance_ratio"),
        )
    ).scalar()
    return counts.withColumn("facts", facts).select(
        "class", "n", "facts.task", "facts.positive_class", "facts.imbalance_ratio"
    )


def correlations(df: DataFrame, columns: list[str], target: str) -> DataFrame:
    """Pearson correlation of each column with the target, over complete pairs.

    NULL with fewer than 3 pairs or without variation.
    """
    y = F.col(target).cast("double")
    entries = []
    for c in columns:
        x = F.col(f"`{c}`").try_cast("double")
        x = F.when(~F.isnan(x) & y.isNotNull(), x)
        paired = F.when(x.isNotNull(), y)
        entries.append(
            F.struct(
                F.lit(c).alias("column"),
                F.count(x).alias("pairs"),
                F.corr(x, paired).alias("r"),
            )
        )
    return df.agg(F.array(*entries).alias("all")).select(F.inline("all")).select(
        "column", "pairs", F.when(F.col("pairs") >= 3, finite(F.col("r"))).alias("pearson")
    )


def _rank_cells(pairs: DataFrame, bins: int, rows: Column) -> DataFrame:
    """(column, value, cell) for the distinct values of each column: ``bins`` groups of about
    equal size by rank, equal values staying together. ``rows`` sums the rows that the pairs stand for."""
    cum = running_totals(pairs, ["column"], "value", {"n": rows})
    cell = F.floor((F.col("cum_n") - F.col("n")) * bins / F.col("all_n")).cast("string")
    return cum.select("column", "value", cell.alias("cell"))


def mutual_information(
    df: DataFrame, numeric: list[str], categorical: list[str], target: str, bins: int = 20, task: str | None = None
) -> DataFrame:
    """Plug-in mutual information (nats) of each column with the target.

    Numeric columns, and the target where ``task`` begins with regress, are cut into ``bins``
    groups by rank. Counts stay long, (column, cell, target cell), for any number of classes.
    Pairs with a missing side are left out; columns with fewer than 20 pairs give NULL.
    """
    known = df.filter(F.col(target).isNotNull())
    if str(task or "").startswith("regress"):
        known = known.withColumn("_t", F.col(target).cast("double")).filter(~F.isnan("_t"))
        own = known.select(F.lit(target).alias("column"), F.col("_t").alias("value"))
        cells = _rank_cells(own, bins, F.count(F.lit(1))).select(F.col("value").alias("_t"), F.col("cell").alias("_y"))
        known = known.join(cells, "_t")
    else:
        known = known.withColumn("_y", F.col(target).cast("string"))
    tables = []
    if categorical:
        pairs = [
            F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("cell"))
            for c in categorical
        ]
        tables.append(
            known.select("_y", F.explode(F.array(*pairs)).alias("p"))
            .filter(F.col("p.cell").isNotNull())
            .groupBy("p.column", "p.cell", "_y")
            .agg(F.count(F.lit(1)).alias("n"))
        )
    if numeric:
        pairs = [
            F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("double").alias("value"))
            for c in numeric
        ]
        counts = (
            known.select("_y", F.explode(F.array(*pairs)).alias("p"))
            .select("_y", "p.column", "p.value")
            .filter("value is not null and not isnan(value)")
            .groupBy("column", "value", "_y")
            .agg(F.count(F.lit(1)).alias("n"))
        )
        counts = staged(counts, "value-counts")  # read for the ranks and for the cells
        tables.append(
            counts.join(_rank_cells(counts, bins, F.sum("n")), ["column", "value"])
            .groupBy("column", "cell", "_y")
            .agg(F.sum("n").alias("n"))
        )
    table = tables[0] if len(tables) == 1 else tables[0].unionByName(tables[1])
    # I(x, y) = ln N + (sum_xy n ln n - sum_x n ln n - sum_y n ln n) / N: three grouped sums.
    weight = F.sum(F.col("n") * F.log(F.col("n").cast("double")))
    both = table.groupBy("column").agg(weight.alias("xy"), F.sum("n").alias("total"))
    by_x = table.groupBy("column", "cell").agg(F.sum("n").alias("n")).groupBy("column")
    by_y = table.groupBy("column", "_y").agg(F.sum("n").alias("n")).groupBy("column")
    joined = both.join(by_x.agg(weight.alias("x")), "column").join(by_y.agg(weight.alias("y")), "column")
    total = F.col("total").cast("double")
    info = F.log(total) + (F.col("xy") - F.col("x") - F.col("y")) / F.nullif(total, F.lit(0.0))
    return joined.select(
        "column", F.when(F.col("total") >= 20, F.greatest(info, F.lit(0.0))).alias("mutual_information")
    )


def leakage(df: DataFrame, target: str) -> DataFrame:
    """Columns that equal the target in all rows but at most one."""
    types = dict(df.dtypes)
    number = kinds(df)
    same = [
        c
        for c in df.columns
        if c != target
        and (types[c] == types[target] or number[c] == number[target] == "number")
    ]
    if not same:
        return df.sparkSession.createDataFrame([], "column string, matches bigint, leaks boolean")
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            F.count_if(F.col(f"`{c}`") == F.col(f"`{target}`")).alias("matches"),
            F.count(F.lit(1)).alias("n_rows"),
        )
        for c in same
    ]
    return df.agg(F.array(*entries).alias("all")).select(F.inline("all")).select(
        "column", "matches", (F.col("matches") >= F.col("n_rows") - 1).alias("leaks")
    )


def preview(df: DataFrame, key: list[str], n: int = 100) -> DataFrame:
    return df.orderBy(*key).limit(n)


# ---------------------------------------------------------------- the card


def data_card(df: DataFrame, opts: ProfileOptions) -> DataFrame:
    """One row per column with everything the plan needs, nested as in a JSON card."""
    df = without_nan(first_columns(df, opts.max_columns))
    profile = staged(column_profile(df, opts), "profile")  # one row per column, read twice
    # The card's own column list: one row per column of the table.
    typed = {r["column"]: r["inferred_type"] for r in profile.select("column", "inferred_type").collect()}
    numbers = [c for c, t in typed.items() if t == "numeric" and c != opts.target]
    discrete = [c for c, t in typed.items() if t in ("categorical", "boolean")]
    card = profile
    if numbers:
        quartiles = exact_quantiles(df, numbers, QUARTILES)
        card = card.join(quartiles, "column", "left")
    if discrete:
        top = top_values(df, discrete, opts.top_k).groupBy("column").agg(
            F.sort_array(F.collect_list(F.struct("place", "value", "n"))).alias("topk")
        )  # at most top_k entries per column
        card = card.join(top, "column", "left")
    if opts.target and opts.target in df.columns:
        if numbers and kinds(df)[opts.target] == "number":
            card = card.join(
                correlations(df, numbers, opts.target).select("column", "pearson"), "column", "left"
            )
        cats = [c for c in discrete if c != opts.target]
        if numbers or cats:
            card = card.join(
                mutual_information(df, numbers, cats, opts.target, task=opts.task), "column", "left"
            )
        card = card.join(leakage(df, opts.target).select("column", "leaks"), "column", "left")
    else:
        card = card.withColumn("leaks", F.lit(False))
    return card.withColumn("leaks", F.coalesce("leaks", F.lit(False))).withColumn(
        "coverage_days", coverage_days(F.col("min_time"), F.col("max_time"))
    )
