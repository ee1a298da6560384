"""Cohort builder: (person, index month) rows with look-back features and a forward label.

Input tables (``ClaimTables``) carry raw, partly unparseable columns; the builder
parses them safely, derives flags, and hands all windows to ``month_windows``.
"""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabml.functions import month_windows as mw
from tabml.functions.lookup import lookup
from tabml.functions.scalars import hash_order, padded, safe_date, safe_days, safe_money
from tabml.session import let_go, staged

KEY = "person_id"
MONTH = mw.MONTH
NEVER = 9999

HALF_YEAR = mw.DaySpan(-180, -1)
HALF_YEAR_TO_INDEX = mw.DaySpan(-180, 0)
NEXT_90 = mw.DaySpan(1, 90)
LAST_30 = mw.DaySpan(-30, -1)
PRIOR_30 = mw.DaySpan(-60, -31)
TWELVE_MONTHS = mw.MonthSpan(12)


@dataclass(frozen=True)
class ClaimTables:
    member: DataFrame  # person_id
    header: DataFrame  # one row per claim
    line: DataFrame  # claim_id, revenue_code
    diagnosis: DataFrame  # person_id, claim_id, dx_code
    pharmacy: DataFrame  # fills
    provider: DataFrame  # provider_id, specialty


@dataclass(frozen=True)
class CohortOptions:
    drug_pattern: str = "%STATIN%"
    coverage_index: datetime.date = datetime.date(2025, 6, 30)
    coverage_days: int = 180
    # Emergency revenue codes and inpatient bill type prefixes.
    er_prefix: str = "045"
    er_code: str = "0981"
    inpatient_prefixes: tuple[str, ...] = ("11", "12")
    inpatient_type: str = "INST"
    unknown_specialty: str = "UNK"
    # Months whose label horizon runs past the last claim count as negative unless set.
    require_full_horizon: bool = False


# ---------------------------------------------------------------- projections


def header_projection(header: DataFrame) -> DataFrame:
    return header.filter(F.col("service_from").isNotNull()).select(
        KEY,
        "claim_id",
        F.upper("claim_type").alias("claim_type"),
        "drg",
        padded(F.col("bill_type")).alias("bill_type3"),
        safe_date(F.col("service_from")).alias("svc_from"),
        safe_date(F.col("service_thru")).alias("svc_thru"),
        "provider_id",
        safe_money(F.col("allowed_amount")).alias("allowed"),
        safe_money(F.col("copay_amount")).alias("copay"),
        safe_money(F.col("coinsurance_amount")).alias("coinsurance"),
        safe_money(F.col("deductible_amount")).alias("deductible"),
    )


def line_flags(line: DataFrame, opts: CohortOptions) -> DataFrame:
    code = F.col("revenue_code")
    er = code.startswith(opts.er_prefix) | (code == opts.er_code)
    return line.groupBy("claim_id").agg(
        F.max(F.when(er, 1).otherwise(0)).alias("has_er_revenue")
    )


def inpatient(opts: CohortOptions) -> Column:
    bill = F.col("bill_type3")
    starts = bill.startswith(opts.inpatient_prefixes[0])
    for prefix in opts.inpatient_prefixes[1:]:
        starts = starts | bill.startswith(prefix)
    return (F.col("claim_type") == opts.inpatient_type) & (F.col("drg").isNotNull() | starts)


def flagged_headers(tables: ClaimTables, opts: CohortOptions) -> DataFrame:
    """Header rows with ``er`` and ``is_acute``; ``ambulatory`` is NULL when undecidable."""
    er = F.coalesce(F.col("has_er_revenue"), F.lit(0)) == 1
    return (
        header_projection(tables.header)
        .join(line_flags(tables.line, opts), "claim_id", "left")
        .withColumn("er", er)
        .withColumn("is_acute", F.when(inpatient(opts) | er, 1).otherwise(0))
        .withColumn("ambulatory", ~er & ~inpatient(opts))
        .drop("has_er_revenue")
    )


def fills(pharmacy: DataFrame) -> DataFrame:
    return pharmacy.filter(F.col("fill_date").isNotNull()).select(
        KEY,
        safe_date(F.col("fill_date")).alias("fill_day"),
        "ndc",
        "prescriber_id",
        safe_days(F.col("days_supply")).alias("supply"),
        safe_money(F.col("paid_amount")).alias("rx_paid"),
        "drug_name",
    )


def dated_diagnoses(tables: ClaimTables, headers: DataFrame | None = None) -> DataFrame:
    """(person, day, dx3, rows): the day is the claim's, the person the diagnosis' own.

    Counted per claim and prefix before the join, so that a claim with very many
    diagnoses brings few rows to it.
    """
    dates = (header_projection(tables.header) if headers is None else headers).select("claim_id", "svc_from")
    counted = (
        tables.diagnosis.select(KEY, "claim_id", F.substring(F.upper("dx_code"), 1, 3).alias("dx3"))
        .groupBy(KEY, "claim_id", "dx3")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    return counted.join(dates, "claim_id")


# ---------------------------------------------------------------- spine and label


def month_spine(tables: ClaimTables) -> DataFrame:
    """Distinct (person, index month, index date) of members with a dated claim."""
    days = header_projection(tables.header).select(KEY, "svc_from")
    months = (
        days.filter(F.col("svc_from").isNotNull())
        .select(KEY, F.trunc("svc_from", "MM").alias(MONTH))
        .distinct()
    )
    return months.join(tables.member.select(KEY), KEY, "left_semi").withColumn(
        "index_date", F.last_day(MONTH)
    )


def _seen(span) -> mw.Measure:
    return mw.Measure("seen", span, "max", F.lit(1))


def windowed(spine: DataFrame, events: DataFrame, day: str, measures: list[mw.Measure]) -> DataFrame:
    """Measures at the spine months that have an event in the first measure's span."""
    totals = mw.window_totals(events, KEY, day, [_seen(measures[0].span), *measures])
    return mw.assemble(spine, KEY, totals=[totals]).filter(F.col("seen") == 1).drop("seen")


def distinct_windowed(
    spine: DataFrame,
    events: DataFrame,
    day: str,
    idents: dict[str, tuple[Column, object]],
    rows: Column | None = None,
) -> DataFrame:
    """Distinct counts over the window, and the event count as ``n_<name>``.

    ``idents`` maps the output name to (identifier, span); a NULL identifier counts
    in ``n_<name>`` only.
    """
    stream = tagged(events, day, {k: ident for k, (ident, _) in idents.items()}, rows)
    spans = {k: span for k, (_, span) in idents.items()}
    return mw.assemble(spine, KEY, steps=distinct_parts([(stream, spans)], tuple(spans)))


def tagged(
    events: DataFrame, day: str, idents: dict[str, Column], rows: Column | None = None
) -> DataFrame:
    """One row per (event, kind) with the identifier, from one scan of the events.

    Identifiers keep their type if they share one; else they become text. ``rows`` is
    the number of events a row stands for.
    """
    weight = F.lit(1) if rows is None else rows
    found = events.select(*[c.alias(k) for k, c in idents.items()]).dtypes
    same = len({kind for _, kind in found}) == 1
    pairs = [
        F.struct(
            F.lit(kind).alias("kind"), (ident if same else ident.cast("string")).alias("ident")
        )
        for kind, ident in idents.items()
    ]
    exploded = events.select(
        KEY,
        F.col(day).alias("day"),
        weight.cast("long").alias("rows"),
        F.explode(F.array(*pairs)).alias("t"),
    )
    return exploded.select(KEY, "day", "rows", "t.kind", "t.ident")


def distinct_parts(
    streams: list[tuple[DataFrame, dict[str, object]]], counted: tuple[str, ...] = (), heavy: list | None = None
) -> list[DataFrame]:
    """Steps of tagged streams, given with the spans of their kinds: one pass per
    identifier type, so that numbers need not travel as text."""
    passes: dict[str, tuple[DataFrame, dict[str, object]]] = {}
    for stream, spans in streams:
        kind = dict(stream.dtypes)["ident"]
        if kind in passes:
            before, known = passes[kind]
            stream, spans = before.unionByName(stream), {**known, **spans}
        passes[kind] = (stream, spans)
    return [
        mw.distinct_steps(
            stream, KEY, "kind", "ident", "day", spans, tuple(k for k in spans if k in counted), "rows", heavy
        )
        for stream, spans in passes.values()
    ]


def forward_label(tables: ClaimTables, opts: CohortOptions) -> DataFrame:
    return windowed(
        month_spine(tables),
        flagged_headers(tables, opts),
        "svc_from",
        [mw.Measure("y_acute_90", NEXT_90, "max", F.col("is_acute"))],
    )


# ---------------------------------------------------------------- single features


def ed_visits(tables: ClaimTables, opts: CohortOptions) -> DataFrame:
    """Distinct claims with an emergency line, index date included."""
    code = F.col("revenue_code")
    er_lines = tables.line.filter(code.startswith(opts.er_prefix) | (code == opts.er_code))
    headers = header_projection(tables.header).join(er_lines, "claim_id", "left_semi")
    out = distinct_windowed(
        month_spine(tables), headers, "svc_from",
        {"ed_visits_180d": (F.col("claim_id"), HALF_YEAR_TO_INDEX)},
    )
    return out.filter(F.col("n_ed_visits_180d") > 0).drop("n_ed_visits_180d")


def covered_days(opts: CohortOptions) -> Column:
    """Days of a fill of the named drug that lie in the window before the fixed index date;
    NULL for other fills, unparseable supplies and fills outside the window."""
    index = F.lit(opts.coverage_index)
    opens = F.date_sub(index, opts.coverage_days)
    stop = F.least(F.date_add("fill_day", F.col("supply")), index)
    days = F.greatest(F.lit(0), F.datediff(stop, F.greatest("fill_day", opens)))
    counts = (
        F.col("drug_name").ilike(opts.drug_pattern)
        & F.col("supply").isNotNull()
        & F.col("fill_day").between(opens, index)
    )
    return F.when(counts, days)


def coverage_ratio(pharmacy: DataFrame, opts: CohortOptions) -> DataFrame:
    """Days covered by the named drug before one fixed index date, per person.

    Overlapping fills add up, so the ratio may exceed 1.
    """
    days = fills(pharmacy).select(KEY, covered_days(opts).alias("days"))
    return days.filter(F.col("days").isNotNull()).groupBy(KEY).agg(
        (F.sum("days") / F.lit(float(opts.coverage_days))).alias("pdc_180d")
    )


def claim_measures() -> list[mw.Measure]:
    """All additive features of a claim header, by output name."""
    stay = F.greatest(
        F.lit(1), F.datediff(F.coalesce("svc_thru", "svc_from"), F.col("svc_from")) + 1
    )
    zero = F.lit(0.0)
    out_of_pocket = (
        F.coalesce("copay", zero) + F.coalesce("coinsurance", zero) + F.coalesce("deductible", zero)
    )
    one = F.lit(1)
    return [
        mw.Measure("y_acute_90", NEXT_90, "max", F.col("is_acute")),
        mw.Measure("ip_acute_180d", HALF_YEAR, "sum", F.col("is_acute")),
        mw.Measure("los_days_180d", HALF_YEAR, "sum", stay),
        mw.Measure("oop_180d", HALF_YEAR, "sum", out_of_pocket),
        mw.Measure("allowed_180d", HALF_YEAR, "sum", F.coalesce("allowed", zero)),
        mw.Measure("claims_30d", LAST_30, "sum", one),
        mw.Measure("claims_prev30d", PRIOR_30, "sum", one),
        mw.Measure("last_claim", mw.EntryMonth(), "max", F.col("svc_from")),
    ]


def claim_feature(tables: ClaimTables, opts: CohortOptions, *names: str) -> DataFrame:
    chosen = [m for m in claim_measures() if m.name in names]
    return windowed(month_spine(tables), flagged_headers(tables, opts), "svc_from", chosen)


def ambulatory_visits(tables: ClaimTables, opts: CohortOptions) -> DataFrame:
    headers = flagged_headers(tables, opts).filter("ambulatory")
    out = distinct_windowed(
        month_spine(tables), headers, "svc_from",
        {"ambulatory_visits_180d": (F.col("claim_id"), HALF_YEAR)},
    )
    return out.filter(F.col("n_ambulatory_visits_180d") > 0).drop("n_ambulatory_visits_180d")


def diagnosis_breadth(tables: ClaimTables) -> DataFrame:
    out = distinct_windowed(
        month_spine(tables), dated_diagnoses(tables), "svc_from",
        {"dx_unique3_12m": (F.col("dx3"), TWELVE_MONTHS)},
        F.col("rows"),
    )
    return out.withColumnRenamed("n_dx_unique3_12m", "dx_count_12m").filter("dx_count_12m > 0")


def fill_measures(opts: CohortOptions) -> list[mw.Measure]:
    named = F.col("drug_name").ilike(opts.drug_pattern)
    return [
        mw.Measure("fills_180d", HALF_YEAR, "sum", F.lit(1)),
        mw.Measure("rx_paid_180d", HALF_YEAR, "sum", F.coalesce("rx_paid", F.lit(0.0))),
        mw.Measure("named_fills_180d", HALF_YEAR, "sum", F.when(named, 1)),
        mw.Measure("last_named", HALF_YEAR, "max", F.when(named, F.col("fill_day"))),
    ]


FILL_IDENTS = {"rx_ndc_unique_180d": "ndc", "rx_prescribers_180d": "prescriber_id"}


def pharmacy_use(tables: ClaimTables, opts: CohortOptions) -> DataFrame:
    # Written once, narrow: totals and distinct counts need other columns, so each would read and join the claims anew.
    rx = staged(fills(tables.pharmacy).select(KEY, "fill_day", "rx_paid", *FILL_IDENTS.values()), "fills")
    heavy = mw.heavy_keys([rx], KEY)
    measures = [m for m in fill_measures(opts) if m.name in ("fills_180d", "rx_paid_180d")]
    totals = mw.window_totals(rx, KEY, "fill_day", measures, heavy)
    stream = tagged(rx, "fill_day", {k: F.col(c) for k, c in FILL_IDENTS.items()})
    steps = distinct_parts([(stream, {k: HALF_YEAR for k in FILL_IDENTS})], heavy=heavy)
    out = mw.assemble(month_spine(tables), KEY, totals=[totals], steps=steps)
    return out.filter("fills_180d > 0")


def days_since(last: str, name: str) -> Column:
    return F.datediff(F.last_day(MONTH), F.col(last)).alias(name)


def named_drug_recency(tables: ClaimTables, opts: CohortOptions) -> DataFrame:
    measures = [m for m in fill_measures(opts) if m.name in ("named_fills_180d", "last_named")]
    totals = mw.window_totals(fills(tables.pharmacy), KEY, "fill_day", measures)
    return (
        mw.assemble(month_spine(tables), KEY, totals=[totals])
        .filter("named_fills_180d > 0")
        .select(KEY, MONTH, "named_fills_180d", days_since("last_named", "days_since_last_named"))
    )


def claim_recency(tables: ClaimTables) -> DataFrame:
    """Days since the latest claim before the index date, however long ago."""
    headers = header_projection(tables.header)
    chosen = [m for m in claim_measures() if m.name == "last_claim"]
    totals = mw.window_totals(headers, KEY, "svc_from", chosen)
    return (
        mw.assemble(month_spine(tables), KEY, totals=[totals], latest=("last_claim",))
        .filter(F.col("last_claim").isNotNull())
        .select(KEY, MONTH, days_since("last_claim", "days_since_last_claim"))
    )


def _specialty_days(headers: DataFrame, provider: DataFrame, opts: CohortOptions) -> DataFrame:
    """(person, day, specialty as identifier). Claims are first cut to distinct days of a
    provider."""
    days = headers.select(KEY, F.col("svc_from").alias("day"), "provider_id").distinct()
    found = lookup(days, provider.select("provider_id", "specialty"), "provider_id")
    return found.select(
        KEY,
        "day",
        F.lit(1).cast("long").alias("rows"),
        F.lit("provider_specialties_180d").alias("kind"),
        F.coalesce("specialty", F.lit(opts.unknown_specialty)).alias("ident"),
    )


def provider_spread(tables: ClaimTables, opts: CohortOptions) -> DataFrame:
    headers = header_projection(tables.header)
    specialties = _specialty_days(headers, tables.provider, opts)
    steps = distinct_parts(
        [
            (
                tagged(headers, "svc_from", {"providers_180d": F.col("provider_id")}),
                {"providers_180d": HALF_YEAR},
            ),
            (specialties, {"provider_specialties_180d": HALF_YEAR}),
        ],
        counted=("providers_180d",),
    )
    out = mw.assemble(month_spine(tables), KEY, steps=steps)
    names = ("providers_180d", "provider_specialties_180d")
    return out.filter("n_providers_180d > 0").select(KEY, MONTH, *names)


def utilisation_trend(tables: ClaimTables, opts: CohortOptions) -> DataFrame:
    """30-day and prior 30-day claim counts; months without claims keep zeros."""
    names = ("claims_30d", "claims_prev30d")
    measures = [m for m in claim_measures() if m.name in names]
    totals = mw.window_totals(header_projection(tables.header), KEY, "svc_from", measures)
    out = mw.assemble(month_spine(tables), KEY, totals=[totals])
    return out.select(KEY, MONTH, *[F.coalesce(n, F.lit(0)).alias(n) for n in names])


# ---------------------------------------------------------------- feature table

# Output columns after the keys; the default replaces a missing value.
FEATURES = {
    "ed_visits_180d": 0,
    "pdc_180d": 0.0,
    "y_acute_90": 0,
    "ip_acute_180d": 0,
    "los_days_180d": 0,
    "oop_180d": 0.0,
    "allowed_180d": 0.0,
    "ambulatory_visits_180d": 0,
    "dx_count_12m": 0,
    "dx_unique3_12m": 0,
    "fills_180d": 0,
    "rx_ndc_unique_180d": 0,
    "rx_prescribers_180d": 0,
    "rx_paid_180d": 0.0,
    "named_fills_180d": 0,
    "days_since_last_named": NEVER,
    "days_since_last_claim": NEVER,
    "providers_180d": 0,
    "provider_specialties_180d": 0,
    "claims_30d": 0,
    "claims_prev30d": 0,
}


def feature_table(tables: ClaimTables, opts: CohortOptions) -> DataFrame:
    """All features at the spine: one union, one aggregation.

    Each source table is read once: parsed claims and fills are written as narrow tables, which
    the features then read as often as they need. Distinct counts shuffle the events of all but
    heavy persons once; sums keep their order of adding up, on which fits depend to the last bit.
    """
    headers = staged(flagged_headers(tables, opts), "claims")
    rx = staged(fills(tables.pharmacy), "fills")
    dx = staged(dated_diagnoses(tables, headers), "diagnoses")
    let_go(headers.sparkSession)
    heavy = mw.heavy_keys([headers, rx, dx], KEY)

    in_month = mw.Measure("in_spine", mw.OwnMonth(), "max", F.lit(1))
    claims = mw.window_totals(headers, KEY, "svc_from", [in_month, *claim_measures()])
    # Months without a claim of their own are not asked for; they only pass on the last one.
    claims = claims.filter((F.col("in_spine") == 1) | F.col("last_claim").isNotNull())
    covered = mw.Measure("covered", mw.OwnMonth(), "sum", covered_days(opts))
    drugs = mw.window_totals(rx, KEY, "fill_day", [covered, *fill_measures(opts)])

    claim_id = F.col("claim_id")
    header_idents = {
        "ed_visits_180d": F.when(F.col("er"), claim_id),
        "ambulatory_visits_180d": F.when(F.col("ambulatory"), claim_id),
        "providers_180d": F.col("provider_id"),
    }
    header_spans = {k: HALF_YEAR for k in header_idents} | {"ed_visits_180d": HALF_YEAR_TO_INDEX}
    present = F.col("ident").isNotNull()
    specialties = _specialty_days(headers, tables.provider, opts)
    steps = distinct_parts(
        [
            (tagged(headers, "svc_from", header_idents).filter(present), header_spans),
            (
                tagged(rx, "fill_day", {k: F.col(c) for k, c in FILL_IDENTS.items()}).filter(present),
                {k: HALF_YEAR for k in FILL_IDENTS},
            ),
            (
                tagged(dx, "svc_from", {"dx_unique3_12m": F.col("dx3")}, F.col("rows")),
                {"dx_unique3_12m": TWELVE_MONTHS},
            ),
            (specialties, {"provider_specialties_180d": HALF_YEAR}),
        ],
        counted=("dx_unique3_12m",),
        heavy=heavy,
    )

    # The claims pass also yields the spine: months with a claim of their own.
    rows = mw.assemble(
        None,
        KEY,
        totals=[claims, drugs],
        steps=steps,
        latest=("last_claim",),
        overall=("covered",),
    )
    rows = rows.withColumnRenamed("n_dx_unique3_12m", "dx_count_12m").join(
        tables.member.select(KEY), KEY, "left_semi"
    )
    if opts.require_full_horizon:
        last = headers.agg(F.max("svc_from").alias("last")).scalar()
        rows = rows.filter(F.date_add(F.last_day(MONTH), NEXT_90.newest) <= last)
    rows = (
        rows.withColumn("days_since_last_named", days_since("last_named", "d"))
        .withColumn("days_since_last_claim", days_since("last_claim", "d"))
        .withColumn("pdc_180d", F.col("covered") / F.lit(float(opts.coverage_days)))
    )
    return rows.select(
        KEY, MONTH, *[F.coalesce(c, F.lit(v)).alias(c) for c, v in FEATURES.items()]
    )


# ---------------------------------------------------------------- balanced sample


_SAMPLE_PARTS = 64


def balanced_sample(
    features: DataFrame, label: str = "y_acute_90", quota: int = 100
) -> DataFrame:
    """Up to ``quota`` positives and as many negatives, or ``2 * quota - positives``
    negatives when positives are short, in md5 order of the key.

    A class is ranked in ``_SAMPLE_PARTS`` parts first; of each part the first ``2 * quota``
    rows go on to the second ranking, so no class is ever gathered, whatever the quota.
    """
    order = [hash_order(F.col(KEY), F.col(MONTH)), F.col(KEY), F.col(MONTH)]
    part = F.pmod(F.xxhash64(KEY, MONTH), F.lit(_SAMPLE_PARTS))
    inner = Window.partitionBy(label, "_part").orderBy(*order)
    few = features.withColumn("_part", part).withColumn("_place", F.row_number().over(inner))
    few = few.filter(F.col("_place") <= 2 * quota).drop("_part", "_place")
    ranked = few.withColumn(
        "rn", F.row_number().over(Window.partitionBy(label).orderBy(*order))
    ).filter(F.col("rn") <= 2 * quota)
    head = ranked.withColumn(
        "positives", F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).over(Window.partitionBy())
    )
    enough = F.when(F.col("positives") >= quota, quota).otherwise(2 * quota - F.col("positives"))
    allowed = F.when(F.col(label) == 1, quota).when(F.col(label) == 0, enough)
    return head.filter(F.col("rn") <= allowed).drop("rn", "positives")


def latest_rows(sample: DataFrame, n: int = 200) -> DataFrame:
    return sample.orderBy(F.col(MONTH).desc(), F.col(KEY)).limit(n)
