"""Profile and plan queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.views import OPTIONS, cast_all, claims, table, with_views
from tabml.operators import cohort, information, profile
from tabml.plans import rules

VISIT_OPTIONS = profile.ProfileOptions(target="y", id_column="claim_id")
NUMBERS = ["allowed", "copay", "coinsurance", "deductible"]
CATEGORIES = ["segment", "claim_type", "drg", "region_code"]


def visits(spark, sf):
    """Claims with member attributes and the acute flag as label: a mixed-type table."""
    t = claims(spark, sf)
    flagged = cohort.flagged_headers(t, OPTIONS)
    return flagged.join(t.member, "person_id", "left").select(
        "claim_id",
        "person_id",
        "segment",
        "region_code",
        "claim_type",
        "drg",
        F.col("svc_from").cast("timestamp").alias("svc_at"),
        *NUMBERS,
        "provider_id",
        F.col("is_acute").alias("y"),
    )


VISITS = """x_visits as (
  select claim_id, visit.person_id, segment, region_code, kind as claim_type, drg,
    cast(day as timestamp) as svc_at, allowed, copay, coinsurance, deductible, provider_id, acute as y
  from visit left join x_member on visit.person_id = x_member.person_id)"""
VISIT_KINDS = {
    "claim_id": "number", "person_id": "number", "segment": "string", "region_code": "number",
    "claim_type": "string", "drg": "string", "svc_at": "time", "allowed": "number", "copay": "number",
    "coinsurance": "number", "deductible": "number", "provider_id": "number", "y": "number",
}
VISIT_TYPES = {
    "claim_id": "bigint", "person_id": "bigint", "segment": "string", "region_code": "int",
    "claim_type": "string", "drg": "string", "svc_at": "timestamp", "allowed": "double",
    "copay": "double", "coinsurance": "double", "deductible": "double", "provider_id": "bigint",
    "y": "int",
}
DOC_KINDS = {
    "doc_id": "number", "text": "string", "lang": "string", "source": "string", "n_chars": "number",
}
LINE_KINDS = {
    "l_orderkey": "number", "l_partkey": "number", "l_suppkey": "number", "l_linenumber": "number",
    "l_quantity": "number", "l_extendedprice": "number", "l_discount": "number", "l_tax": "number",
    "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "time",
}
CARDS = {
    "binary": ("x_visits", VISIT_KINDS, VISIT_OPTIONS),
    "classes": ("lineitem", LINE_KINDS, profile.ProfileOptions(target="l_returnflag", id_column="l_orderkey")),
    "numeric": (
        "lineitem", LINE_KINDS,
        profile.ProfileOptions(target="l_extendedprice", id_column="l_orderkey", task="regression"),
    ),
}


def over_visits(body: str) -> str:
    body = body.strip()
    rest = ",\n" + body[5:] if body.startswith("with ") else "\n" + body
    return with_views("visit x_member", f"with {VISITS}{rest}")


def _type_rows(source: str, name: str, kinds: dict[str, str], target: str, id_column: str) -> str:
    """One select per column with its logical type and role."""
    parts = []
    for c, kind in kinds.items():
        number = f"try_cast(cast({c} as varchar) as double)"
        length = f"avg(length({c}))" if kind == "string" else "null"
        # integers never fall between -1 and 2 other than 0 and 1
        parts.append(
            f"""select '{name}' as source, '{c}' as "column", count(distinct {c}) as u, count(*) as n,
  bool_and(coalesce({number} > -1 and {number} < 2, true)) as zo, {length} as len, '{kind}' as kind
  from {source}"""
        )
    union = "\n union all ".join(parts)
    return f"""select source, "column",
  case when "column" = '{id_column}' or regexp_matches("column", '(_ID$|^ID$|ID_)', 'i') then 'id'
    when kind = 'time' then 'datetime'
    when u <= 2 and coalesce(zo, true) then 'boolean'
    when kind = 'number' then 'numeric'
    when len >= 20 then 'text' else 'categorical' end as inferred_type,
  case when "column" = '{target}' then 'target' when "column" = '{id_column}' then 'id'
    else 'feature' end as role,
  cast(kind = 'string' and u::double / greatest(n, 1) > 0.9 as bigint) as unique_text, u, n
  from ({union})"""


def _typed(spark, sf):
    docs = profile.ProfileOptions(target="lang", id_column="doc_id")
    return (
        profile.column_profile(visits(spark, sf), VISIT_OPTIONS).withColumn("source", F.lit("visits"))
    ).unionByName(
        profile.column_profile(table(spark, sf, "documents"), docs).withColumn(
            "source", F.lit("documents")
        )
    )


TYPED = over_visits(
    "with typed as (" + _type_rows("x_visits", "visits", VISIT_KINDS, "y", "claim_id")
    + "\n union all " + _type_rows("documents", "documents", DOC_KINDS, "lang", "doc_id") + ")\n"
)


def _profile_sql() -> str:
    parts = []
    for c, kind in VISIT_KINDS.items():
        num = kind == "number"
        when = kind == "time"
        parts.append(
            f"""select '{c}' as "column", '{VISIT_TYPES[c]}' as dtype, count({c}) as non_null,
  count(*) - count({c}) as nulls, round(100.0::double * (count(*) - count({c})) / count(*), 4) as missing_pct,
  count(distinct {c}) as n_unique, round(count(distinct {c})::double / count(*), 6) as unique_ratio,
  cast(count(distinct {c}) <= 1 as bigint) as constant,
  cast(count(distinct {c})::double / count(*) > 0.5 as bigint) as high_cardinality,
  {f'round(min({c})::double, 6)' if num else 'null::double'} as min,
  {f'round(max({c})::double, 6)' if num else 'null::double'} as max,
  {f'round(avg({c}::double), 6)' if num else 'null::double'} as mean,
  {f'round(stddev_samp({c}::double), 6)' if num else 'null::double'} as std,
  {f'min({c})' if when else 'null::timestamp'} as min_time,
  {f'max({c})' if when else 'null::timestamp'} as max_time
  from x_visits"""
        )
    return over_visits("\n union all ".join(parts))


def _leaky(spark, sf):
    orders = table(spark, sf, "orders")
    return orders.select(
        "o_orderkey",
        "o_orderstatus",
        "o_orderpriority",
        F.col("o_orderstatus").alias("copied"),
        F.when(F.col("o_orderkey") == 1, "X").otherwise(F.col("o_orderstatus")).alias("one_off"),
        F.when(F.col("o_orderkey") <= 2, "X").otherwise(F.col("o_orderstatus")).alias("some_off"),
    )


def _by_table(spark, sf, build):
    parts = [
        build(table(spark, sf, name)).withColumn("source", F.lit(name))
        for name in ("orders", "events", "lineitem")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _card(spark, sf):
    return profile.data_card(visits(spark, sf), VISIT_OPTIONS)


def _card_rows(name):
    def rows(spark, sf):
        source, _, opts = CARDS[name]
        df = visits(spark, sf) if source == "x_visits" else table(spark, sf, source)
        card = profile.data_card(df, opts)
        shown = ["column", "inferred_type", "role", "suspected_id", "leaks", "missing_pct", "coverage_days"]
        figures = [c for c in ("q1", "median", "q3", "pearson", "mutual_information") if c in card.columns]
        return cast_all(card.select(*shown, *figures, F.size("topk").alias("n_top")))

    return rows


def _card_sql(name):
    """Every figure of the card by a plain aggregate of its own."""
    source, kinds, opts = CARDS[name]
    target, regress = opts.target, opts.task is not None
    number = [c for c, k in kinds.items() if k == "number" and c != target]
    other = [c for c in kinds if c != target]
    goal = f"cast(floor(20 * (rank() over (order by {target}) - 1) / count(*) over ()) as varchar)" if regress else f"cast({target} as varchar)"
    figures = " union all ".join(
        f"""select '{c}' as "column", quantile_cont({c}, 0.25) as q1, quantile_cont({c}, 0.5) as median,
  quantile_cont({c}, 0.75) as q3 from {source}"""
        for c in number
    )
    pairs = " union all ".join(
        f"""select '{c}' as "column", case when count({c}) >= 3 then corr({c}::double, {target}::double) end as pearson
  from {source} where {c} is not null and {target} is not null"""
        for c in number
    )
    by_rank = " union all ".join(
        f"""select '{c}' as "column", 'rank' as how, cast(cell as varchar) as cell, y, count(*) as n from (
  select y, floor(20 * (rank() over (order by {c}) - 1) / count(*) over ()) as cell from goals where {c} is not null)
  group by cell, y"""
        for c in number
    )
    by_value = " union all ".join(
        f"""select '{c}' as "column", 'value' as how, cast({c} as varchar) as cell, y, count(*) as n
  from goals where {c} is not null group by cell, y"""
        for c in other
    )
    alike = [c for c in other if kinds[c] == kinds[target]]
    leaks = " union all ".join(
        f"""select '{c}' as "column", count(*) filter ({c} = {target}) >= count(*) - 1 as leaks from {source}"""
        for c in alike
    )
    facts = " union all ".join(
        f"""select '{c}' as "column", round(100.0::double * (count(*) - count({c})) / count(*), 4) as missing_pct,
  {f"floor(date_diff('second', min({c}), max({c})) / 86400)" if k == "time" else "null"} as coverage_days,
  least(10, count(distinct {c}) + max(({c} is null)::int)) as n_top from {source}"""
        for c, k in kinds.items()
    )
    body = f"""with typed as ({_type_rows(source, source, kinds, target, opts.id_column)}),
 goals as (select *, {goal} as y from {source} where {target} is not null),
 figures as ({figures}), pairs as ({pairs}), leaks as ({leaks}), facts as ({facts}),
 cells as ({by_rank} union all {by_value}),
 j as (
  select *, sum(n) over (partition by "column", how, cell) as nx, sum(n) over (partition by "column", how, y) as ny,
    sum(n) over (partition by "column", how) as total from cells),
 mi as (
  select "column", how, case when max(total) >= 20 then
    greatest(sum(n::double / total * ln(total::double * n / (nx::double * ny))), 0) end as mutual_information
  from j group by all),
 t as (select *, inferred_type = 'numeric' and "column" <> '{target}' as counted,
    inferred_type in ('categorical', 'boolean') as listed from typed)
select t."column", inferred_type, role, cast(inferred_type = 'id' or unique_text = 1 as bigint) as suspected_id,
  cast(coalesce(leaks, false) as bigint) as leaks, missing_pct, cast(coverage_days as bigint) as coverage_days,
  {", ".join(f"round(case when counted then {q} end, 6) as {q}" for q in ("q1", "median", "q3"))},
  {"round(case when counted then pearson end, 6) as pearson," if kinds[target] == "number" else ""}
  round(mutual_information, 6) as mutual_information, cast(case when listed then n_top else null end as bigint) as n_top
from t left join figures using ("column") left join pairs using ("column") left join leaks using ("column")
  left join facts using ("column")
  left join mi on mi."column" = t."column" and t."column" <> '{target}'
    and how = case when counted then 'rank' when listed then 'value' end"""
    if kinds[target] != "number":
        body = body.replace(f"pairs as ({pairs}), ", "").replace('left join pairs using ("column") ', "")
    return over_visits(body) if source == "x_visits" else body


def _blocks(spark, sf):
    blocks = rules.model_blocks(visits(spark, sf), "y").withColumn("ranges", F.size(F.from_json("ranges", "array<string>")))
    return cast_all(blocks)


def _on_visits(build):
    return lambda spark, sf: cast_all(build(visits(spark, sf)))


NEAR_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _neighbour_sql() -> str:
    """Windows over the whole column: the third nearest of the class, then a range count around each value."""

    def psi(x: str) -> str:
        t = f"({x} + 6.0::double)"
        back = " ".join(f"- 1 / ({x} + {i}.0::double)" for i in range(6))
        return f"(ln({t}) - 1 / (2 * {t}) - 1 / (12 * {t} * {t}) + 1 / (120 * pow({t}, 4)) - 1 / (252 * pow({t}, 6)) {back})"

    away = ", ".join([f"v - lag(v, {i}) over w" for i in (1, 2, 3)] + [f"lead(v, {i}) over w - v" for i in (1, 2, 3)])
    values = " union all ".join(
        f"""select '{c}' as col, l_returnflag as y, cast(round(({c} - (select avg({c}) from lineitem)) /
  (select stddev_pop({c}) from lineitem) * 1000000) as bigint) * 1000000 + jitter as v from j"""
        for c in NEAR_COLUMNS
    )
    return f"""with j as (
  select *, cast(floor(('0x' || substr(md5(concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)), 1, 8))::bigint
    / 4294967296.0::double * 1000000) as bigint) as jitter from lineitem),
 p as ({values}),
 d as (
  select *, count(*) over (partition by col, y) as size, [{away}] as near from p window w as (partition by col, y order by v)),
 r as (
  select *, least(3, size - 1) as k, list_sort(list_filter(near, lambda x: x is not null))[least(3, size - 1)] as r
  from d where size > 1),
 m as (
  select *, count(*) over (partition by col order by v range between greatest(r - 1, 0) preceding and greatest(r - 1, 0) following) as within
  from r)
select col as "column", round(greatest({psi("count(*)")} + avg({psi("k")}) - avg({psi("size")}) - avg({psi("within")}), 0), 6)
  as mutual_information
from m group by col"""


QUERIES = {
    "e01_dataset_summary": lambda spark, sf: cast_all(
        profile.dataset_summary(table(spark, sf, "lineitem"))
    ),
    "e02_column_profile": _on_visits(
        lambda v: profile.column_profile(v, VISIT_OPTIONS).select(
            "column", "dtype", "non_null", "nulls", "missing_pct", "n_unique", "unique_ratio",
            "constant", "high_cardinality", "min", "max", "mean", "std", "min_time", "max_time",
        )
    ),
    "e03_top_values": _on_visits(lambda v: profile.top_values(v, [*CATEGORIES, "y"], 10)),
    "e03_top_known_values": lambda spark, sf: cast_all(
        profile.top_values(table(spark, sf, "documents"), ["lang", "source", "text"], 5, False)
    ),
    "e04_inferred_types": lambda spark, sf: _typed(spark, sf).select(
        "source", "column", "inferred_type", "role"
    ),
    "e05_quantiles": _on_visits(lambda v: profile.numeric_summary(v, NUMBERS)),
    "e06_time_coverage": lambda spark, sf: _by_table(spark, sf, profile.time_coverage),
    "e07_pearson": _on_visits(
        lambda v: profile.correlations(v, [*NUMBERS, "region_code"], "y")
    ),
    "e08_mutual_information": _on_visits(
        lambda v: profile.mutual_information(v, NUMBERS, CATEGORIES, "y")
    ),
    "e08_neighbour_information": lambda spark, sf: cast_all(
        information.neighbour_information(
            table(spark, sf, "lineitem"), NEAR_COLUMNS, "l_returnflag", key=("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
        )
    ),
    "e09_target_summary": _on_visits(lambda v: profile.target_summary(v, "y")),
    "e10_leakage": lambda spark, sf: cast_all(profile.leakage(_leaky(spark, sf), "o_orderstatus")),
    "e11_suspected_ids": lambda spark, sf: _typed(spark, sf)
    .filter("suspected_id")
    .select("source", "column"),
    "e12_preview": _on_visits(lambda v: profile.preview(v, ["claim_id"], 100)),
    **{f"e13_card_{name}": _card_rows(name) for name in CARDS},
    "p01_column_plan": lambda spark, sf: cast_all(rules.column_plan(_card(spark, sf))),
    "p02_class_weights": _on_visits(lambda v: rules.class_weights(v, "y")),
    "p03_time_split_rule": lambda spark, sf: cast_all(
        _by_table(
            spark, sf, lambda df: rules.time_split_rule(profile.time_coverage(df), None)
        )
    ),
    "p04_search_space": lambda spark, sf: cast_all(rules.search_space(visits(spark, sf))),
    "p05_model_blocks": lambda spark, sf: _blocks(spark, sf),
    "x03_encoder_by_levels": lambda spark, sf: rules.column_plan(
        _card(spark, sf), encoder_rule="levels"
    ).select("column", "bucket", "encoder"),
    "x06_constant_columns": _on_visits(
        lambda v: profile.column_profile(
            v.withColumn("fixed", F.lit(7)).withColumn("empty", F.lit(None).cast("string"))
        )
        .filter("constant")
        .select("column", "n_unique")
    ),
}

PLAN_RULE = """case when role = 'target' then 'target'
    when inferred_type = 'categorical' then case when {high} then 'categorical_high' else 'categorical_low' end
    when inferred_type = 'id' then 'ids' else inferred_type end as bucket"""
ENCODER = """case when bucket in ('categorical_low', 'boolean') then 'onehot'
    when bucket = 'categorical_high' then 'target_mean' when bucket = 'numeric' then 'standardise'
    when bucket = 'text' then 'ignore' end as encoder"""


def _coverage(name: str, column: str) -> str:
    return f"""select '{name}' as source, '{column}' as "column", min({column}) as min_time,
  max({column}) as max_time,
  cast(floor((epoch(date_trunc('second', max({column}))) - epoch(date_trunc('second', min({column})))) / 86400) as bigint)
    as coverage_days from {name}"""


COVERAGE = "\n union all ".join(
    [_coverage("orders", "o_orderdate"), _coverage("events", "ts"), _coverage("lineitem", "l_shipdate")]
)


def _top(source: str, columns: list[str], k: int, nulls: bool) -> str:
    parts = "\n union all ".join(
        f"""select '{c}' as "column", cast({c} as varchar) as value, count(*) as n from {source}
  {'' if nulls else f'where {c} is not null'} group by 2"""
        for c in columns
    )
    return f"""select * from (
  select *, row_number() over (partition by "column" order by n desc, value asc nulls last) as place
  from ({parts})) where place <= {k}"""


def _mi_sql() -> str:
    cells = [
        f"""select '{c}' as "column", cast({c} as varchar) as cell, y, count(*) as n
  from x_visits where {c} is not null group by 2, 3"""
        for c in CATEGORIES
    ]
    cells += [
        f"""select '{c}' as "column", cast(cell as varchar) as cell, y, count(*) as n from (
  select y, floor(20 * below / total) as cell from (
    select y, rank() over (order by {c}) - 1 as below, count(*) over () as total
    from x_visits where {c} is not null)) group by cell, y"""
        for c in NUMBERS
    ]
    return over_visits(
        f"""with cells as ({chr(10) + ' union all '.join(cells)}),
 j as (
  select *, sum(n) over (partition by "column", cell) as nx, sum(n) over (partition by "column", y) as ny,
    sum(n) over (partition by "column") as total from cells)
select "column", round(case when max(total) >= 20 then
  greatest(sum(n::double / total * ln(total::double * n / (nx::double * ny))), 0) end, 6) as mutual_information
from j group by 1"""
    )


SQL = {
    **{f"e13_card_{name}": _card_sql(name) for name in CARDS},
    "p05_model_blocks": over_visits(
        f"""with c as (select count(*) filter (y = 1) as p, count(*) filter (y = 0) as q from x_visits),
 f as (select round(greatest(1, q::double / p), 4) as weight, greatest(p, q)::double / least(p, q) >= 3 as uneven from c)
select model, only_if, fit_params, cast(ranges as bigint) as ranges from (values ('lightgbm', {sum(r[0] == 'lightgbm' for r in rules.SPACE) + 1}), ('xgboost', {sum(r[0] == 'xgboost' for r in rules.SPACE)}),
  ('catboost', {sum(r[0] == 'catboost' for r in rules.SPACE)}), ('logreg', {sum(r[0] == 'logreg' for r in rules.SPACE)})) m(model, ranges),
 (select 1::bigint as only_if), lateral (select case model
    when 'lightgbm' then '{{"is_unbalance":' || uneven || '}}'
    when 'xgboost' then '{{"scale_pos_weight":' || weight || '}}'
    when 'catboost' then case when uneven then '{{"auto_class_weights":"Balanced"}}' else '{{}}' end
    else '{{}}' end as fit_params from f)"""
    ),
    "e01_dataset_summary": f"""with d as (select distinct * from lineitem)
select (select count(*) from lineitem) as n_rows, {len(LINE_KINDS)}::bigint as n_cols,
  round(100.0::double * (1.0::double - (select count(*) from d)::double / (select count(*) from lineitem)), 4)
    as dup_row_pct""",
    "e02_column_profile": _profile_sql(),
    "e03_top_values": over_visits(_top("x_visits", [*CATEGORIES, "y"], 10, True)),
    "e03_top_known_values": _top("documents", ["lang", "source", "text"], 5, False),
    "e04_inferred_types": TYPED + 'select source, "column", inferred_type, role from typed',
    "e05_quantiles": over_visits(
        "\n union all ".join(
            f"""select '{c}' as "column", round(avg({c}), 6) as mean, round(stddev_samp({c}), 6) as std,
  round(min({c}), 6) as min, round(max({c}), 6) as max, round(quantile_cont({c}, 0.25), 6) as q1,
  round(quantile_cont({c}, 0.5), 6) as median, round(quantile_cont({c}, 0.75), 6) as q3 from x_visits"""
            for c in NUMBERS
        )
    ),
    "e06_time_coverage": COVERAGE,
    "e07_pearson": over_visits(
        "\n union all ".join(
            f"""select '{c}' as "column", count({c}) as pairs, round(corr({c}::double, y::double), 6) as pearson
  from x_visits where {c} is not null"""
            for c in [*NUMBERS, "region_code"]
        )
    ),
    "e08_mutual_information": _mi_sql(),
    "e08_neighbour_information": _neighbour_sql(),
    "e09_target_summary": over_visits(
        """with c as (select cast(y as varchar) as class, count(*) as n from x_visits group by 1)
select class, n, 'binary' as task, '1' as positive_class,
  round(max(n) over ()::double / min(n) over (), 4) as imbalance_ratio from c"""
    ),
    "e10_leakage": """with c as (
  select o_orderkey, o_orderstatus, o_orderpriority, o_orderstatus as copied,
    case when o_orderkey = 1 then 'X' else o_orderstatus end as one_off,
    case when o_orderkey <= 2 then 'X' else o_orderstatus end as some_off from orders),
 m as ("""
    + "\n union all ".join(
        f"""select '{c}' as "column", count(*) filter ({c} = o_orderstatus) as matches, count(*) as n from c"""
        for c in ("o_orderpriority", "copied", "one_off", "some_off")
    )
    + """)
select "column", matches, cast(matches >= n - 1 as bigint) as leaks from m""",
    "e11_suspected_ids": TYPED
    + """select source, "column" from typed where inferred_type = 'id' or unique_text = 1""",
    "e12_preview": over_visits(
        """select claim_id, person_id, segment, cast(region_code as bigint) as region_code, claim_type, drg,
  svc_at, round(allowed, 6) as allowed, round(copay, 6) as copay, round(coinsurance, 6) as coinsurance,
  round(deductible, 6) as deductible, provider_id, cast(y as bigint) as y
from x_visits order by claim_id limit 100"""
    ),
    "p01_column_plan": TYPED
    + f""", b as (select *, {PLAN_RULE.format(high='u::double / n > 0.5')} from typed where source = 'visits'),
 l as (
"""
    + "\n union all ".join(
        f"""  select '{c}' as "column", count(*) filter ({c}::double = y) >= count(*) - 1 as leaks from x_visits"""
        for c, k in VISIT_KINDS.items()
        if k == "number" and c != "y"
    )
    + f""")
select b."column", bucket, cast(inferred_type = 'id' or unique_text = 1 or coalesce(leaks, false) as bigint) as dropped,
  case when bucket = 'numeric' then 'median'
    when bucket in ('categorical_low', 'categorical_high', 'boolean') then 'most_frequent' end as imputer,
  {ENCODER}
from b left join l on l."column" = b."column" """,
    "p02_class_weights": over_visits(
        """with c as (select cast(y as varchar) as class, count(*) as n from x_visits group by 1)
select class, n, round(sum(n) over ()::double / (count(*) over () * n), 6) as balanced_weight,
  cast(class = '1' as bigint) as positive,
  round(greatest(1.0::double, (sum(n) over () - (select n from c where class = '1'))::double
    / (select n from c where class = '1')), 4) as pos_weight,
  cast(max(n) over ()::double / min(n) over () >= 3 as bigint) as imbalanced from c"""
    ),
    "p03_time_split_rule": f"""select source, "column", coverage_days,
  cast(coverage_days >= 180 as bigint) as time_aware from ({COVERAGE})""",
    "p04_search_space": over_visits(
        "with n as (select count(*) as n from x_visits), s(model, param, kind, low, high) as (values "
        + ", ".join(
            f"('{m}', '{p}', '{k}', {lo!r}::double, {hi!r}::double)"
            for m, p, k, lo, hi in rules.SPACE
            if m in rules.CLASSIFIERS
        )
        + """)
select s.*, 1::bigint as only_if from s, n
union all
select 'lightgbm', 'min_data_in_leaf', 'int', greatest(10, floor(n * 0.001::double))::double,
  greatest(20, floor(n * 0.05::double))::double, 1 from n"""
    ),
    "x03_encoder_by_levels": TYPED
    + f""", b as (select *, {PLAN_RULE.format(high='u > 50')} from typed where source = 'visits')
select "column", bucket, {ENCODER} from b""",
    "x06_constant_columns": over_visits(
        "with v as (select *, 7 as fixed, null::varchar as empty from x_visits), c as ("
        + "\n union all ".join(
            f"""select '{c}' as "column", count(distinct {c}) as n_unique from v"""
            for c in [*VISIT_KINDS, "fixed", "empty"]
        )
        + """)
select * from c where n_unique <= 1"""
    ),
}
