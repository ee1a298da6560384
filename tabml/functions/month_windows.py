"""Look-back and look-forward features per (key, index month), without range joins.

The index date of a month is its last day. So the index months whose window holds
an event on day ``d`` form one interval ``[start(d), end(d))`` of months that
follows from ``d`` alone, and neither sums nor distinct counts need a join between
months and events:

* sums and maxima: events are first aggregated per (key, day), then each day is
  spread over its months and aggregated per (key, month);
* distinct counts: an identifier counts in a month through its *latest* day in the
  window, so each (identifier, day) adds 1 at ``start(d)`` and takes it back at
  ``end(d)`` or at the start of the identifier's next day, whichever comes first.
  A running sum of these steps over the months is the distinct count.

A key may hold any share of the events: every shuffle that has the key alone as
its partitioning comes after an aggregation to at most one row per calendar day or
month of the key. Where ``heavy_keys`` has counted the events, all keys but the heavy ones are
shuffled once, by the key alone, and everything above happens where their rows then lie.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabml.session import bounded_rows

MONTH = "index_month"
HEAVY_ROWS = 1_000_000  # events that one task may get of a key


@dataclass(frozen=True)
class DaySpan:
    """Events with ``index_date + oldest <= day <= index_date + newest``."""

    oldest: int
    newest: int

    def start(self, day: Column) -> Column:
        return F.trunc(F.date_sub(day, self.newest), "MM")

    def end(self, day: Column) -> Column:
        return F.trunc(F.date_sub(day, self.oldest - 1), "MM")


@dataclass(frozen=True)
class MonthSpan:
    """Events from ``months`` calendar months before the index date to the day before it."""

    months: int

    def start(self, day: Column) -> Column:
        return F.trunc(F.date_add(day, 1), "MM")

    def end(self, day: Column) -> Column:
        same = F.add_months(F.trunc(day, "MM"), self.months)
        reaches = F.add_months(F.last_day(same), -self.months) <= day
        return F.when(reaches, F.add_months(same, 1)).otherwise(same)


@dataclass(frozen=True)
class OwnMonth:
    """Only the calendar month of the event."""

    def start(self, day: Column) -> Column:
        return F.trunc(day, "MM")

    def end(self, day: Column) -> Column:
        return F.add_months(self.start(day), 1)


@dataclass(frozen=True)
class EntryMonth:
    """The first month whose index date lies after the event.

    A running maximum over the months turns it into "latest event before".
    """

    def start(self, day: Column) -> Column:
        return F.trunc(F.date_add(day, 1), "MM")

    def end(self, day: Column) -> Column:
        return F.add_months(self.start(day), 1)


@dataclass(frozen=True)
class Measure:
    """``how`` ('sum' or 'max') of ``value`` over the events of the span."""

    name: str
    span: object
    how: str
    value: Column


def _widest(pick, cols: list[Column]) -> Column:
    return cols[0] if len(cols) == 1 else pick(*cols)


def heavy_keys(tables: list[DataFrame], key: str, most: int = HEAVY_ROWS) -> list:
    """The keys with more than ``most`` rows in the tables together; there are at most rows / ``most``."""
    rows = tables[0].select(key)
    for t in tables[1:]:
        rows = rows.unionAll(t.select(key))
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most)
    return [r[key] for r in bounded_rows(counts, 100_000, "heavy keys")]


def _dealt(events: DataFrame, key: str, heavy: list | None, build: Callable[[DataFrame, bool], DataFrame]) -> DataFrame:
    """``build(events, True)`` of events dealt by the key; those of heavy keys, or of all if unknown, stay as they are."""
    if heavy is None:
        return build(events, False)
    if not heavy:
        return build(events.repartition(key), True)
    mine = F.coalesce(F.col(key).isin([k for k in heavy if k is not None]), F.lit(None in heavy))
    return build(events.filter(~mine).repartition(key), True).unionByName(build(events.filter(mine), False))


def window_totals(
    events: DataFrame, key: str, day: str, measures: list[Measure], heavy: list | None = None
) -> DataFrame:
    """One row per (key, index_month) that some event's window touches; ``heavy`` as from ``heavy_keys``."""
    return _dealt(events, key, heavy, lambda some, dealt: _totals(some, key, day, measures, dealt))


def _totals(events: DataFrame, key: str, day: str, measures: list[Measure], dealt: bool) -> DataFrame:
    combine = {"sum": F.sum, "max": F.max}
    at = F.col(day)
    daily = (
        events.filter(at.isNotNull())
        .groupBy(key, day)
        .agg(*[combine[m.how](m.value).alias(m.name) for m in measures])
    )
    spans = list(dict.fromkeys(m.span for m in measures))
    place = {s: i for i, s in enumerate(spans)}
    # The interval of each span is worked out once per day, not once per month of it.
    edges = {f"_s{i}": s.start(at) for s, i in place.items()}
    edges |= {f"_e{i}": s.end(at) for s, i in place.items()}
    first = _widest(F.least, [F.col(f"_s{i}") for i in place.values()])
    stop = _widest(F.greatest, [F.col(f"_e{i}") for i in place.values()])
    months = F.when(
        first < stop, F.sequence(first, F.add_months(stop, -1), F.expr("interval 1 month"))
    )
    month = F.col(MONTH)

    def inside(m: Measure) -> Column:
        i = place[m.span]
        return F.when((month >= F.col(f"_s{i}")) & (month < F.col(f"_e{i}")), F.col(m.name))

    # At most one row per calendar day and key is left, so the key alone is a safe
    # partitioning, and the spread rows are aggregated where they are made.
    return (
        (daily if dealt else daily.repartition(key))
        .withColumns(edges)
        .withColumn(MONTH, F.explode(months))
        .groupBy(key, MONTH)
        .agg(*[combine[m.how](inside(m)).alias(m.name) for m in measures])
    )


def distinct_steps(
    events: DataFrame,
    key: str,
    kind: str,
    ident: str,
    day: str,
    spans: dict[str, object],
    counted: tuple[str, ...] = (),
    rows: str | None = None,
    heavy: list | None = None,
) -> DataFrame:
    """Steps of the distinct count of ``ident`` for each kind, one column per kind.

    For the ``counted`` kinds ``n_<kind>`` holds the steps of the plain row count over
    the same span. Rows with a NULL identifier count there only. Events that were
    counted before name the column with their number of ``rows``; ``heavy`` as from ``heavy_keys``.
    """
    return _dealt(events, key, heavy, lambda some, _: _steps(some, key, kind, ident, day, spans, counted, rows))


def _steps(
    events: DataFrame, key: str, kind: str, ident: str, day: str, spans: dict[str, object], counted: tuple[str, ...], rows: str | None
) -> DataFrame:
    at = F.col(day)
    kinds = list(spans)
    # Kinds travel through the shuffles as small numbers.
    code = F.lit(None).cast("int")
    for i, k in enumerate(kinds):
        code = F.when(F.col(kind) == k, i).otherwise(code)
    days = (
        events.filter(at.isNotNull())
        .select(key, code.alias(kind), ident, day, (F.col(rows) if rows else F.lit(1)).alias("n"))
        .groupBy(key, kind, ident, day)
        .agg(F.sum("n").alias("n"))
    )
    later = F.lead(at).over(Window.partitionBy(key, kind, ident).orderBy(at))

    def by_kind(edge) -> Column:
        """``edge`` of the row's own span; kinds with equal spans share one branch."""
        chosen = F.lit(None).cast("date")
        for span in dict.fromkeys(spans.values()):
            same = [i for i, k in enumerate(kinds) if spans[k] == span]
            chosen = F.when(F.col(kind).isin(same), edge(span)).otherwise(chosen)
        return chosen

    one = F.col(ident).isNotNull().cast("long")
    marked = days.withColumn("later", later).select(
        key,
        kind,
        "n",
        one.alias("one"),
        by_kind(lambda s: s.start(at)).alias("opens"),
        by_kind(lambda s: s.end(at)).alias("closes"),
        by_kind(lambda s: s.start(F.col("later"))).alias("renews"),
    )
    zero = F.lit(0).cast("long")

    def step(month: Column, unique: Column, rows: Column) -> Column:
        return F.struct(month.alias("month"), unique.alias("unique"), rows.alias("rows"))

    distinct = [
        step(F.col("opens"), F.col("one"), F.col("n")),
        step(F.least("closes", "renews"), -F.col("one"), zero),
    ]
    steps = F.array(*distinct)
    if counted:
        plain = F.array(*distinct, step(F.col("closes"), zero, -F.col("n")))
        codes = [i for i, k in enumerate(kinds) if k in counted]
        steps = F.when(F.col(kind).isin(codes), plain).otherwise(steps)
    exploded = marked.select(key, kind, F.explode(steps).alias("s"))
    return exploded.groupBy(key, F.col("s.month").alias(MONTH)).agg(
        *[F.sum(F.when(F.col(kind) == i, F.col("s.unique"))).alias(k) for i, k in enumerate(kinds)],
        *[
            F.sum(F.when(F.col(kind) == i, F.col("s.rows"))).alias(f"n_{k}")
            for i, k in enumerate(kinds)
            if k in counted
        ],
    )


def assemble(
    spine: DataFrame | None,
    key: str,
    totals: list[DataFrame] = (),
    steps: list[DataFrame] = (),
    latest: tuple[str, ...] = (),
    overall: tuple[str, ...] = (),
) -> DataFrame:
    """Bring feature parts onto the spine: one union, one aggregation, no joins.

    ``totals`` hold final values per (key, month), ``steps`` hold steps to be summed
    over the months, ``latest`` names columns to carry forward as running maximum and
    ``overall`` columns to be summed over all months of the key.
    Months that carry nothing are NULL for totals and 0 for steps. Without a spine,
    one of the totals marks its months by ``in_spine`` = 1.
    """
    id_cols = {key, MONTH, "in_spine"}
    total_cols = [c for d in totals for c in d.columns if c not in id_cols]
    step_cols = [c for d in steps for c in d.columns if c not in id_cols]
    parts = [*totals, *steps]
    if spine is not None:
        parts.insert(0, spine.select(key, MONTH, F.lit(1).alias("in_spine")))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    # Every part has at most one row per key and calendar month by now.
    merged = (
        rows.repartition(key)
        .groupBy(key, MONTH)
        .agg(
            F.max("in_spine").alias("in_spine"),
            *[F.max(c).alias(c) for c in total_cols],
            *[F.sum(c).alias(c) for c in step_cols],
        )
    )
    so_far = (
        Window.partitionBy(key).orderBy(MONTH).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    carried = [F.coalesce(F.sum(c).over(so_far), F.lit(0)).alias(c) for c in step_cols]
    carried += [F.max(c).over(so_far).alias(c) for c in latest]
    carried += [F.sum(c).over(Window.partitionBy(key)).alias(c) for c in overall]
    plain = [c for c in total_cols if c not in latest and c not in overall]
    return (
        merged.select(key, MONTH, "in_spine", *plain, *carried)
        .filter(F.col("in_spine") == 1)
        .drop("in_spine")
    )
