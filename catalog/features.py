"""Feature, split and declared-extra queries."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from catalog.profile import NUMBERS, TYPED, PLAN_RULE, ENCODER, _card, over_visits, visits
from catalog.views import cast_all, table
from tabml.operators import extras, features, labels, split
from tabml.operators.features import FeaturePlan, Preprocessor
from tabml.plans import rules

HELD_OUT = "MACHINERY"
VISIT_SPLIT = split.SplitOptions(key=("claim_id",), method="random")
TEST_EDGE, VAL_EDGE = f"{int(0.15 * 2**32):08x}", f"{int(0.3 * 2**32):08x}"


def _train(v):
    """Training rows; one segment is kept out so that it is unseen later."""
    return split.random_split(v, VISIT_SPLIT).filter("split = 'train'").filter(
        (F.col("segment") != HELD_OUT) | F.col("segment").isNull()
    )


def _fitted(v, **groups):
    plan = FeaturePlan(target="y", positive="1", **groups)
    return Preprocessor.of(plan).fit(_train(v))


def _out_of_fold(v):
    """Five folds by claim; the mean label of a value over the other four."""
    plan = FeaturePlan(target="y", positive="1", target_mean=["segment", "provider_id"])
    return features.out_of_fold_means(v.withColumn("fold", F.col("claim_id") % 5), plan, {"segment": "none"})


def _visit_query(build):
    return lambda spark, sf: cast_all(build(visits(spark, sf)))


def _labelled_orders(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.expr("case when o_orderstatus = 'P' then null else cast(o_orderstatus = 'F' as int) end").alias("label"),
    )


def _label_forms(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row_key"),
        F.expr("case when l_returnflag = 'R' then ' True' else 'false' end").alias("words"),
        F.expr("case l_returnflag when 'R' then '1.0' when 'A' then '0' end").alias("digits"),
        F.expr("l_linestatus = 'F'").alias("flag"),
        F.expr("l_linenumber % 2").alias("number"),
        F.col("l_returnflag").alias("many"),
    )
    train = lines.filter("many <> 'N'")
    out = lines
    for name in ("words", "digits", "flag", "number"):
        out = labels.encode_binary(out, name, out=f"{name}_y")
    out = labels.encode_binary(out, "digits", positive=1, out="is_one")
    return labels.index_label(out, "many", labels.label_map(train, "many"), "many_id")


ORDER_SPLIT = split.SplitOptions(key=("o_orderkey",), label="o_orderstatus")


def _timed_orders(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.expr("case when o_orderpriority = '5-LOW' and o_orderstatus = 'P' then null else o_orderdate end").alias("seen_at"),
    )


def _orders(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")


# Order and line number repeat in the data; with these a line is told apart.
LINE_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")


CORRELATED = ["l_quantity", "twice", "l_discount", "minus", "l_tax"]


def _correlated(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_quantity", (F.col("l_quantity") * 2 + 1).alias("twice"), "l_discount",
        (F.col("l_discount") * -3).alias("minus"), "l_tax",
    )
    drop = extras.correlated_columns(lines, CORRELATED)
    return lines.drop(*drop).agg(
        *[F.sum(c).alias(c) for c in CORRELATED if c not in drop], F.count(F.lit(1)).alias("n_rows")
    )


def _selected(spark, sf):
    plan = rules.column_plan(_card(spark, sf))
    chosen = FeaturePlan.from_columns(plan, "y", keep_out=["svc_at"])
    rows = [(c, g) for g, cs in (("numeric", chosen.numeric), ("onehot", chosen.onehot),
                                ("target_mean", chosen.target_mean), ("dropped", chosen.dropped)) for c in cs]
    picked = spark.createDataFrame(rows, "column string, used_as string")
    stats = visits(spark, sf).select(*[F.count(c).alias(c) for c in [r[0] for r in rows]])
    known = stats.unpivot([], [r[0] for r in rows], "column", "non_null")
    return picked.join(known, "column")


def _text_weights(spark, sf):
    """Per language: documents with words, distinct terms, occurrences, and total weight."""
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    weights = extras.text_weights(docs, "doc_id", "text", ("lang",))
    per_term = weights.groupBy("lang", "term").agg(
        F.sum("tf").alias("tf"), F.count(F.lit(1)).alias("pairs"), F.sum("weight").alias("weight")
    )
    return per_term.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n_terms"), F.sum("tf").alias("n_words"), F.sum("pairs").alias("n_pairs"),
        F.round(F.sum("weight"), 3).alias("weight"),
    )


# Wide and gappy: the last two columns follow the first two, and are mostly missing.
WIDE = [f"(l_partkey * {7 * i + 3} + l_suppkey * {5 * i + 1}) % {89 + 2 * i}" for i in range(40)]
WIDE += [f"case when l_orderkey % 10 = 0 then 2 * ({WIDE[i]}) + 1 end" for i in range(2)]


def _correlated_wide(spark, sf):
    lines = table(spark, sf, "lineitem").selectExpr(*[f"cast({e} as double) as c{i}" for i, e in enumerate(WIDE)])
    dropped = extras.correlated_columns(lines, lines.columns)
    return spark.createDataFrame([(c,) for c in dropped], "column string")


def _many_levels(spark, sf):
    """One-hot of every part, thousands of levels; rows as (line, slot) of the slots that are set."""
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", F.col("l_partkey").cast("string").alias("part"),
        F.expr("cast(l_returnflag = 'R' as int)").alias("y"),
    )
    plan = FeaturePlan(target="y", onehot=["part"])
    fitted = Preprocessor.of(plan).fit(lines.filter("l_partkey % 10 <> 0"))
    return cast_all(fitted.entries(lines, "l_orderkey", "l_linenumber", "l_suppkey"))


def _worded_label(spark, sf):
    """Target means of a yes/no label: the positive class is the rarer one."""
    v = visits(spark, sf).withColumn("y", F.when(F.col("y") == 1, "yes").otherwise("no"))
    fitted = Preprocessor.of(FeaturePlan(target="y", target_mean=["segment"])).fit(v)
    return cast_all(fitted.named(v, "claim_id"))


QUERIES = {
    "f01_label_fill": lambda spark, sf: cast_all(
        labels.with_label(_labelled_orders(spark, sf), "label", fill=1)
    ),
    "f01_label_drop": lambda spark, sf: cast_all(
        labels.with_label(_labelled_orders(spark, sf), "label")
    ),
    "f02_median_impute": _visit_query(
        lambda v: _fitted(v, numeric=NUMBERS, scale=False).named(v, "claim_id")
    ),
    "f03_mode_impute": _visit_query(
        lambda v: v.select(
            "claim_id",
            *[
                F.coalesce(F.col(r["column"]).cast("string"), F.lit(r["mode"])).alias(r["column"])
                for r in features.modes(_train(v), ["drg", "region_code"]).collect()
            ],
        )
    ),
    "f04_standardise": _visit_query(lambda v: _fitted(v, numeric=NUMBERS).named(v, "claim_id")),
    "f05_one_hot": _visit_query(
        lambda v: _fitted(v, onehot=["segment", "claim_type", "drg"]).named(v, "claim_id")
    ),
    "f06_target_mean": _visit_query(
        lambda v: _fitted(v, target_mean=["segment", "provider_id", "person_id"]).named(v, "claim_id")
    ),
    "f06_out_of_fold_means": lambda spark, sf: cast_all(_out_of_fold(visits(spark, sf))),
    "f05_many_levels": _many_levels,
    "f06_worded_label": _worded_label,
    "f07_month_text": lambda spark, sf: features.months_as_text(
        table(spark, sf, "events").select("event_id", "ts")
    ),
    "f08_stratified_split": lambda spark, sf: split.split_rows(_orders(spark, sf), ORDER_SPLIT),
    "f09_random_split": lambda spark, sf: split.random_split(_orders(spark, sf), ORDER_SPLIT),
    "f10_time_split": lambda spark, sf: split.split_rows(
        _timed_orders(spark, sf),
        split.SplitOptions(key=("o_orderkey",), method="time", timestamp="seen_at"),
    ),
    "f11_label_encodings": lambda spark, sf: cast_all(_label_forms(spark, sf)),
    "f12_column_selection": lambda spark, sf: cast_all(_selected(spark, sf)),
    "x01_date_parts": lambda spark, sf: cast_all(
        extras.date_parts(table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), ["o_orderdate"])
    ),
    "x02_day_difference": lambda spark, sf: cast_all(
        extras.day_difference(
            table(spark, sf, "lineitem").join(
                table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
            ).select("l_orderkey", "l_linenumber", "o_orderdate", "l_shipdate"),
            "days", "o_orderdate", "l_shipdate",
        )
    ),
    "x04_missing_indicators": _visit_query(
        lambda v: extras.missing_indicators(v, ["drg", "allowed", "coinsurance", "provider_id"]).select(
            "claim_id", "drg_missing", "allowed_missing", "coinsurance_missing", "provider_id_missing"
        )
    ),
    "x05_clip": _visit_query(
        lambda v: extras.clip_outliers(v, _train(v), NUMBERS).select("claim_id", *NUMBERS)
    ),
    "x07_correlated_wide": _correlated_wide,
    "x07_correlated": lambda spark, sf: cast_all(_correlated(spark, sf)),
    "x08_undersample": lambda spark, sf: split.undersample(
        _orders(spark, sf), "o_orderstatus", ("o_orderkey",), 1.0
    ),
    "x08_oversample": lambda spark, sf: cast_all(
        split.oversample(_visit_labels(spark, sf), "y", ("claim_id",), 0.9)
    ),
    "x09_synthetic_rows": lambda spark, sf: cast_all(
        split.synthetic_rows(
            table(spark, sf, "lineitem").withColumn("y", F.expr("cast(l_returnflag = 'R' as int)")),
            "y", LINE_KEY, ["l_quantity", "l_extendedprice", "l_discount"], 0.8,
        )
    ),
    "x09_cleaned_rows": lambda spark, sf: split.cleaned(
        table(spark, sf, "orders"), "o_orderstatus", ("o_orderkey",), ["o_totalprice", "o_custkey"]
    ).select("o_orderkey", "o_orderstatus"),
    "x10_folds": lambda spark, sf: cast_all(
        split.stratified_folds(_orders(spark, sf), "o_orderstatus", ("o_orderkey",), 5)
    ),
    "x14_month_cycle": lambda spark, sf: cast_all(
        extras.month_cycle(table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate")
    ),
    "x15_text_weights": _text_weights,
}


def _synthetic_sql() -> str:
    """Copies of the rarer class: how often each row is due, its five nearest of all rows of the class, and the share between."""
    names = ["l_quantity", "l_extendedprice", "l_discount"]
    key = ", ".join(LINE_KEY)
    place = f"md5(concat_ws('-', '42', {key})) || '-' || concat_ws('-', {key})"
    facts = ", ".join(f"stddev_pop({c}) as dev_{c}" for c in names)
    d2 = " + ".join(f"pow((a.{c} - b.{c}) / dev_{c}, 2)" for c in names)
    part = "('0x' || substr(md5({}), 1, 8))::bigint / 4294967296.0::double"
    return f"""with flagged as (select *, cast(l_returnflag = 'R' as int) as y from lineitem),
 sizes as (select y, count(*) as n from flagged group by 1),
 rare as (select y, n from sizes order by n, y limit 1),
 few as (select flagged.*, {place} as place from flagged join rare using (y)),
 facts as (select {facts}, count(*) as n from few),
 want as (select cast(round_even((select max(n) from sizes) * 0.8::double, 0) as bigint) - n as missing from rare),
 ordered as (
  select few.*, n, greatest(missing, 0) as missing, row_number() over (order by place) as nth from few, facts, want),
 ranked as (select *, row_number() over (order by place) as nth from few),
 nearest as (
  select a.nth, min(round(({d2}) * 1e10)::bigint * 10000000 + b.nth, 5) as near
  from ranked a, ranked b, facts where a.nth <> b.nth group by a.nth),
 copied as (
  select *, unnest(range(1, missing // n + cast(nth <= missing % n as int) + 1)) as copy from ordered),
 drawn as (
  select copied.*, {part.format("concat_ws('-', place, copy)")} as share,
    near[1 + cast(floor({part.format("concat_ws('-', 'near', place, copy)")} * len(near)) as int)] % 10000000 as other
  from copied join nearest using (nth))
select {", ".join(f"round(d.{c} + (o.{c} - d.{c}) * share, 6) as {c}" for c in names)}, cast(d.y as bigint) as y, copy
from drawn d join ranked o on o.nth = d.other"""


def _cleaned_sql() -> str:
    names = ["o_totalprice", "o_custkey"]
    d2 = " + ".join(f"pow((a.{c} - b.{c}) / dev_{c}, 2)" for c in names)
    return f"""with p as (
  select *, row_number() over (order by md5(concat_ws('-', '42', o_orderkey)) || '-' || o_orderkey) as nth from orders),
 facts as (select {", ".join(f"stddev_pop({c}) as dev_{c}" for c in names)} from orders),
 nearest as (
  select a.nth, unnest(min(round(({d2}) * 1e10)::bigint * 10000000 + b.nth, 3)) % 10000000 as other
  from p a, p b, facts where a.nth <> b.nth group by a.nth)
select a.o_orderkey, a.o_orderstatus from nearest n join p a on a.nth = n.nth join p b on b.nth = n.other
group by all having 2 * count(*) filter (a.o_orderstatus <> b.o_orderstatus) <= count(*)"""


def _visit_labels(spark, sf):
    return visits(spark, sf).select("claim_id", "y")


TRAIN = f"""train as (
  select * from x_visits where md5(concat_ws('-', '42', claim_id)) >= '{VAL_EDGE}'
    and (segment <> '{HELD_OUT}' or segment is null))"""
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"]
SLOTS = {"segment": SEGMENTS, "claim_type": ["INST", "PROF"], "drg": ["F", "O"]}
ORDER = "md5(concat_ws('-', '42', o_orderkey))"


def _mode(c: str) -> str:
    return f"""(select cast({c} as varchar) from train where {c} is not null group by 1
    order by count(*) desc, 1 limit 1)"""


def _tmean(c: str) -> str:
    return f"coalesce(t_{c}.m, (select avg(y::double) from train))"


def _rank_split(extra: str = "") -> str:
    return f"""with r as (
  select o_orderkey, o_orderstatus, row_number() over (partition by o_orderstatus order by {ORDER}) as rn,
    count(*) over (partition by o_orderstatus) as n from orders),
 k as (select *, round_even(n * 0.15::double, 0) as n_test from r)"""


SQL = {
    "f01_label_fill": """select o_orderkey, case when o_orderstatus = 'P' then 1::bigint
  else cast(o_orderstatus = 'F' as bigint) end as label from orders""",
    "f01_label_drop": """select o_orderkey, cast(o_orderstatus = 'F' as bigint) as label from orders
where o_orderstatus <> 'P'""",
    "f02_median_impute": over_visits(
        f"with {TRAIN}\nselect claim_id, "
        + ", ".join(
            f"round(coalesce({c}, (select quantile_cont({c}, 0.5) from train)), 6) as {c}" for c in NUMBERS
        )
        + " from x_visits"
    ),
    "f03_mode_impute": over_visits(
        f"with {TRAIN}\nselect claim_id, "
        + ", ".join(f"coalesce(cast({c} as varchar), {_mode(c)}) as {c}" for c in ("drg", "region_code"))
        + " from x_visits"
    ),
    "f04_standardise": over_visits(
        f"with {TRAIN},\n m as (select "
        + ", ".join(f"quantile_cont({c}, 0.5) as {c}" for c in NUMBERS)
        + " from train),\n s as (select "
        + ", ".join(
            f"avg(coalesce(t.{c}, m.{c})) as avg_{c}, stddev_pop(coalesce(t.{c}, m.{c})) as sd_{c}"
            for c in NUMBERS
        )
        + " from train t, m)\nselect claim_id, "
        + ", ".join(f"round((coalesce(x.{c}, m.{c}) - avg_{c}) / sd_{c}, 6) as {c}" for c in NUMBERS)
        + " from x_visits x, m, s"
    ),
    "f05_one_hot": over_visits(
        f"with {TRAIN}\nselect claim_id, "
        + ", ".join(
            f"""cast(coalesce({c}, {_mode(c)}) = '{v}' as double) as "{c}={v}" """
            for c, vs in SLOTS.items()
            for v in vs
        )
        + " from x_visits"
    ),
    "f06_out_of_fold_means": over_visits("""with p as (
  select claim_id % 5 as fold, 'segment' as col, coalesce(cast(segment as varchar), 'none') as v, y from x_visits
  union all select claim_id % 5, 'provider_id', cast(provider_id as varchar), y from x_visits),
 k as (select * from p where y is not null and v is not null),
 f as (select distinct fold, col from k)
select f.fold, f.col as "column", k.v as value, round(avg(k.y::double), 6) as mean
from f join k on k.col = f.col and k.fold <> f.fold group by all
union all
select f.fold, f.col, null, round(avg(k.y::double), 6) from f join k on k.col = f.col and k.fold <> f.fold group by all"""),
    "f06_target_mean": over_visits(
        f"with {TRAIN},\n i as (select claim_id, "
        + ", ".join(
            f"coalesce(cast({c} as varchar), {_mode(c)}) as {c}" for c in ("segment", "provider_id", "person_id")
        )
        + " from x_visits),\n"
        + ",\n".join(
            f""" t_{c} as (select coalesce(cast({c} as varchar), {_mode(c)}) as k, avg(y::double) as m
  from train group by 1)"""
            for c in ("segment", "provider_id", "person_id")
        )
        + "\nselect claim_id, "
        + ", ".join(f"round({_tmean(c)}, 6) as {c}_tmean" for c in ("segment", "provider_id", "person_id"))
        + " from i "
        + " ".join(f"left join t_{c} on t_{c}.k = i.{c}" for c in ("segment", "provider_id", "person_id"))
    ),
    "f05_many_levels": """with seen as (select distinct l_partkey from lineitem where l_partkey % 10 <> 0)
select l_orderkey, cast(l_linenumber as bigint) as l_linenumber, l_suppkey, 'part=' || l_partkey as slot, 1.0::double as value
from lineitem semi join seen using (l_partkey)""",
    "f06_worded_label": over_visits(
        """with r as (select case when 2 * sum(y) <= count(*) then 1 else 0 end as rare from x_visits),
 i as (select claim_id, y, coalesce(segment, (select segment from x_visits where segment is not null
    group by 1 order by count(*) desc, 1 limit 1)) as segment from x_visits),
 t as (select segment, avg((y = rare)::int::double) as m from i, r group by 1)
select claim_id, round(m, 6) as segment_tmean from i left join t using (segment)"""
    ),
    "f07_month_text": "select event_id, strftime(ts, '%Y-%m') as ts from events",
    "f08_stratified_split": _rank_split()
    + """,
 v as (select *, round_even((n - n_test) * (0.15::double / 0.85::double), 0) as n_val from k)
select o_orderkey, o_orderstatus, case when rn <= n_test then 'test'
  when rn <= n_test + n_val then 'val' else 'train' end as split from v""",
    "f09_random_split": f"""select o_orderkey, o_orderstatus, case when {ORDER} < '{TEST_EDGE}' then 'test'
  when {ORDER} < '{VAL_EDGE}' then 'val' else 'train' end as split from orders""",
    "f10_time_split": f"""with t as (
  select o_orderkey, case when o_orderpriority = '5-LOW' and o_orderstatus = 'P' then null
    else o_orderdate end as seen_at from orders),
 r as (
  select *, row_number() over (order by seen_at asc nulls last, {ORDER}) as rn, count(*) over () as n from t),
 k as (select *, round_even(n * 0.15::double, 0) as n_test from r),
 v as (select *, round_even((n - n_test) * (0.15::double / 0.85::double), 0) as n_val from k)
select o_orderkey, seen_at, case when rn <= n - n_test - n_val then 'train'
  when rn <= n - n_test then 'val' else 'test' end as split from v""",
    "f11_label_encodings": """select l_orderkey * 10 + l_linenumber as row_key,
  case when l_returnflag = 'R' then ' True' else 'false' end as words,
  case l_returnflag when 'R' then '1.0' when 'A' then '0' end as digits,
  cast(l_linestatus = 'F' as bigint) as flag, cast(l_linenumber % 2 as bigint) as number,
  l_returnflag as many,
  cast(l_returnflag = 'R' as bigint) as words_y,
  cast(l_returnflag = 'R' as bigint) as digits_y,
  cast(l_linestatus = 'F' as bigint) as flag_y, cast(l_linenumber % 2 as bigint) as number_y,
  cast(case l_returnflag when 'R' then 1 when 'A' then 0 end as bigint) as is_one,
  cast(case l_returnflag when 'R' then 1 when 'A' then 0 end as bigint) as many_id
from lineitem""",
    "f12_column_selection": TYPED
    + f""", b as (select *, {PLAN_RULE.format(high='u::double / n > 0.5')} from typed where source = 'visits'),
 e as (select *, {ENCODER}, inferred_type = 'id' or unique_text = 1 or "column" = 'svc_at' as out from b),
 s as (select "column", case when out then 'dropped' when encoder = 'standardise' then 'numeric'
    else encoder end as used_as from e where role <> 'target' or out),
 c as ("""
    + "\n union all ".join(
        f"""select '{c}' as "column", count({c}) as non_null from x_visits"""
        for c in ("claim_id", "person_id", "segment", "region_code", "claim_type", "drg", "svc_at",
                  *NUMBERS, "provider_id")
    )
    + """)
select s."column", used_as, non_null from s join c on c."column" = s."column"
where used_as is not null""",
    "x01_date_parts": """select o_orderkey, o_orderdate, year(o_orderdate) as o_orderdate_year,
  month(o_orderdate) as o_orderdate_month, day(o_orderdate) as o_orderdate_day,
  isodow(o_orderdate) - 1 as o_orderdate_dayofweek, quarter(o_orderdate) as o_orderdate_quarter from orders""",
    "x02_day_difference": """select l_orderkey, cast(l_linenumber as bigint) as l_linenumber, o_orderdate, l_shipdate,
  date_diff('day', cast(o_orderdate as date), cast(l_shipdate as date)) as days
from lineitem join orders on l_orderkey = o_orderkey""",
    "x04_missing_indicators": over_visits(
        "select claim_id, "
        + ", ".join(
            f"cast({c} is null as bigint) as {c}_missing" for c in ("drg", "allowed", "coinsurance", "provider_id")
        )
        + " from x_visits"
    ),
    "x05_clip": over_visits(
        f"with {TRAIN},\n q as (select "
        + ", ".join(
            f"quantile_cont({c}, 0.01) as lo_{c}, quantile_cont({c}, 0.99) as hi_{c}" for c in NUMBERS
        )
        + " from train)\nselect claim_id, "
        + ", ".join(
            f"round(case when {c} is not null then least(greatest({c}, lo_{c}), hi_{c}) end, 6) as {c}"
            for c in NUMBERS
        )
        + " from x_visits, q"
    ),
    "x09_synthetic_rows": _synthetic_sql(),
    "x09_cleaned_rows": _cleaned_sql(),
    "x07_correlated_wide": "with t as (select "
    + ", ".join(f"cast({e} as double) as c{i}" for i, e in enumerate(WIDE))
    + " from lineitem)\n"
    + "\n union all ".join(
        f"""select 'c{j}' as "column" from t having greatest({", ".join(f"abs(corr(c{i}, c{j}))" for i in range(j))}) > 0.95"""
        for j in range(1, len(WIDE))
    ),
    "x15_text_weights": r"""with w as (
  select doc_id, lang, unnest(regexp_extract_all(lower(text), '[^\s]+')) as term from documents),
 p as (select doc_id, lang, term, count(*) as tf from w group by all),
 d as (select term, count(*) as docs from p group by 1),
 n as (select count(*) as n from documents)
select lang, count(distinct term) as n_terms, cast(sum(tf) as bigint) as n_words, count(*) as n_pairs,
  round(sum(tf * ln((n + 1) / (docs + 1))), 3) as weight
from p join d using (term), n group by lang""",
    "x07_correlated": """select round(sum(l_quantity), 6) as l_quantity, round(sum(l_discount), 6) as l_discount,
  round(sum(l_tax), 6) as l_tax, count(*) as n_rows from lineitem""",
    "x08_undersample": f"""with r as (
  select o_orderkey, o_orderstatus, row_number() over (partition by o_orderstatus order by {ORDER}) as rn from orders),
 c as (select min(n) as rare from (select count(*) as n from orders group by o_orderstatus))
select o_orderkey, o_orderstatus from r, c where rn <= greatest(rare, round_even(rare / 1.0::double, 0))""",
    "x08_oversample": over_visits(
        """with r as (
  select claim_id, y, row_number() over (partition by y order by md5(concat_ws('-', '42', claim_id))) as rn,
    count(*) over (partition by y) as n from x_visits),
 g as (select cast(round_even(max(n) * 0.9::double, 0) as bigint) as goal from r),
 t as (select r.*, greatest(goal, n) // n as times, greatest(goal, n) % n as extra from r, g)
select claim_id, cast(y as bigint) as y,
  unnest(generate_series(1, times + case when rn <= extra then 1 else 0 end)) as copy from t"""
    ),
    "x10_folds": f"""with r as (
  select o_orderkey, o_orderstatus, row_number() over (partition by o_orderstatus order by {ORDER}) as rn,
    count(*) over (partition by o_orderstatus) as n from orders)
select o_orderkey, o_orderstatus, cast((rn > n // 5) as bigint) + cast((rn > n * 2 // 5) as bigint)
  + cast((rn > n * 3 // 5) as bigint) + cast((rn > n * 4 // 5) as bigint) as fold from r""",
    "x14_month_cycle": """select o_orderkey, o_orderdate,
  round(sin(month(o_orderdate) * 2 * pi() / 12), 6) as o_orderdate_month_sin,
  round(cos(month(o_orderdate) * 2 * pi() / 12), 6) as o_orderdate_month_cos from orders""",
}
