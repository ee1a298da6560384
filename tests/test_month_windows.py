"""Window features against a plain loop over all pairs of months and events."""

import calendar
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tabml.functions import month_windows as mw


def last_day(m):
    return m.replace(day=calendar.monthrange(m.year, m.month)[1])


def months_back(d, n):
    y, m = divmod(d.year * 12 + d.month - 1 - n, 12)
    return dt.date(y, m + 1, min(d.day, calendar.monthrange(y, m + 1)[1]))


def holds(span, day, month):
    idx = last_day(month)
    if isinstance(span, mw.MonthSpan):
        return months_back(idx, span.months) <= day < idx
    return idx + dt.timedelta(span.oldest) <= day <= idx + dt.timedelta(span.newest)


def make_events(hot_share, seed):
    """Random events around leap days and month ends; one person may hold a third of them."""
    rng = random.Random(seed)
    days = [dt.date(2023, 1, 1) + dt.timedelta(rng.randrange(900)) for _ in range(120)]
    days += [dt.date(2024, 2, 28), dt.date(2024, 2, 29), dt.date(2023, 2, 28), dt.date(2023, 12, 31)]
    rows = []
    for _ in range(600):
        person = 0 if rng.random() < hot_share else rng.randrange(1, 12)
        ident = rng.choice(["a", "b", "c", "d", None])
        rows.append((person, ident, rng.choice(days), rng.randrange(1, 9)))
    return rows


SPANS = {
    "half_year": mw.DaySpan(-180, -1),
    "to_index": mw.DaySpan(-180, 0),
    "ahead": mw.DaySpan(1, 90),
    "short": mw.DaySpan(-30, -1),
    "earlier": mw.DaySpan(-60, -31),
    "year": mw.MonthSpan(12),
}


@pytest.mark.parametrize("hot_share", [0.0, 0.4])
def test_totals_and_distinct_counts(spark, hot_share):
    rows = make_events(hot_share, 7)
    events = spark.createDataFrame(rows, "k int, ident string, day date, v int")
    months = {(k, d.replace(day=1)) for k, _, d, _ in rows}
    spine = spark.createDataFrame(sorted(months), "k int, index_month date")

    measures = [mw.Measure(f"sum_{n}", s, "sum", F.col("v")) for n, s in SPANS.items()]
    measures += [mw.Measure(f"max_{n}", s, "max", F.col("v")) for n, s in SPANS.items()]
    totals = mw.window_totals(events, "k", "day", measures)

    tagged = events.withColumn("kind", F.explode(F.array(*[F.lit(n) for n in SPANS])))
    steps = mw.distinct_steps(tagged, "k", "kind", "ident", "day", SPANS, tuple(SPANS))
    got = mw.assemble(spine, "k", totals=[totals], steps=[steps]).collect()

    assert len(got) == len(months)
    for r in got:
        mine = [x for x in rows if x[0] == r["k"]]
        for name, span in SPANS.items():
            inside = [x for x in mine if holds(span, x[2], r["index_month"])]
            assert (r[f"sum_{name}"] or 0) == sum(x[3] for x in inside)
            assert (r[f"max_{name}"] or 0) == max((x[3] for x in inside), default=0)
            assert r[f"n_{name}"] == len(inside)
            assert r[name] == len({x[1] for x in inside if x[1] is not None})


def test_latest_before_and_overall(spark):
    rows = make_events(0.3, 3)
    events = spark.createDataFrame(rows, "k int, ident string, day date, v int")
    months = sorted({(k, d.replace(day=1)) for k, _, d, _ in rows})
    spine = spark.createDataFrame(months, "k int, index_month date")
    totals = mw.window_totals(
        events, "k", "day",
        [
            mw.Measure("last", mw.EntryMonth(), "max", F.col("day")),
            mw.Measure("all_v", mw.OwnMonth(), "sum", F.col("v")),
        ],
    )
    got = mw.assemble(spine, "k", totals=[totals], latest=("last",), overall=("all_v",)).collect()
    for r in got:
        mine = [x for x in rows if x[0] == r["k"]]
        before = [x[2] for x in mine if x[2] < last_day(r["index_month"])]
        assert r["last"] == max(before, default=None)
        assert r["all_v"] == sum(x[3] for x in mine)


def test_no_join_between_months_and_events(spark):
    """The plan aggregates before it partitions by the key alone, and joins nothing."""
    events = spark.createDataFrame(make_events(0.3, 1), "k int, ident string, day date, v int")
    totals = mw.window_totals(events, "k", "day", [mw.Measure("s", SPANS["year"], "sum", F.col("v"))])
    plan = totals._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    assert plan.count("Aggregate") == 2


@pytest.mark.parametrize("heavy", [[], [0], [0, None, 3]])
def test_light_keys_are_shuffled_once(spark, heavy):
    """The same figures whichever keys count as heavy; without heavy ones a single shuffle, by the key."""
    rows = make_events(0.4, 5) + [(None, "a", dt.date(2024, 5, 5), 3)]
    events = spark.createDataFrame(rows, "k int, ident string, day date, v int")
    measures = [mw.Measure("s", SPANS["year"], "sum", F.col("v")), mw.Measure("m", SPANS["ahead"], "max", F.col("v"))]
    tagged = events.withColumn("kind", F.lit("short"))
    for build in (
        lambda h: mw.window_totals(events, "k", "day", measures, h),
        lambda h: mw.distinct_steps(tagged, "k", "kind", "ident", "day", {"short": SPANS["short"]}, ("short",), heavy=h),
    ):
        got = build(heavy)
        assert sorted(map(str, got.collect())) == sorted(map(str, build(None).collect()))
        if not heavy:
            assert build(heavy)._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_heavy_keys_are_counted_over_all_tables(spark):
    events = spark.createDataFrame([(0,), (0,), (1,), (None,), (None,)], "k int")
    assert set(mw.heavy_keys([events, events.filter("k = 1")], "k", 1)) == {0, 1, None}
    assert mw.heavy_keys([events], "k", 2) == []


def test_pharmacy_joins_its_claims_once(spark, sf):
    """Totals and distinct counts read the written fills, not the view of the claims again."""
    from catalog import cohort as queries

    plan = queries.QUERIES["c13_pharmacy"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_partkey") == 0
