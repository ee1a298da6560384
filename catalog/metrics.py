"""Metric queries over scored line items; scores tie often, on purpose."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.views import cast_all, scored, table, with_views
from tabml.operators import metrics

CLASSES = ("A", "N", "R")


def class_scores(spark, sf):
    """Three made class scores per line item, and the class with the highest one."""
    lines = table(spark, sf, "lineitem")
    cols = [
        (
            (F.col("l_quantity").cast("bigint") * (7 + 4 * i) + F.when(F.col("l_returnflag") == k, 17).otherwise(0))
            % 91
            / F.lit(91.0)
        ).alias(f"s_{k}")
        for i, k in enumerate(CLASSES)
    ]
    rows = lines.select(F.col("l_returnflag").alias("actual"), *cols)
    top = F.greatest(*[F.col(f"s_{k}") for k in CLASSES])
    guess = F.when(F.col("s_A") == top, "A").when(F.col("s_N") == top, "N").otherwise("R")
    return rows.withColumn("guess", guess)


X_CLASS = """x_class as (
  select l_returnflag as actual,
    (cast(l_quantity as bigint) * 7 + case when l_returnflag = 'A' then 17 else 0 end) % 91 / 91.0::double as s_a,
    (cast(l_quantity as bigint) * 11 + case when l_returnflag = 'N' then 17 else 0 end) % 91 / 91.0::double as s_n,
    (cast(l_quantity as bigint) * 15 + case when l_returnflag = 'R' then 17 else 0 end) % 91 / 91.0::double as s_r
  from lineitem)"""
X_GUESS = """x_guess as (
  select actual, case when s_a = greatest(s_a, s_n, s_r) then 'A'
    when s_n = greatest(s_a, s_n, s_r) then 'N' else 'R' end as guess from x_class)"""

TOTALS = """g as (
  select grp, score, sum(y) as pos, sum(1 - y) as neg from x_scored group by 1, 2),
 t as (
  select *, sum(pos) over w as cum_pos, sum(neg) over w as cum_neg,
    sum(pos) over (partition by grp) as p, sum(neg) over (partition by grp) as n
  from g window w as (partition by grp order by score desc rows unbounded preceding))"""

DECISION = "l_quantity * 3 - l_extendedprice / 1000"


def _macro(spark, sf):
    rows = metrics.one_vs_rest(class_scores(spark, sf), "actual", {k: f"s_{k}" for k in CLASSES})
    return cast_all(metrics.macro_ranking(rows))


def _by_group(build):
    return lambda spark, sf: cast_all(build(scored(spark, sf)))


QUERIES = {
    "v01_confusion": _by_group(lambda s: metrics.confusion(s, 0.5, ["grp"])),
    "v02_average_precision": _by_group(
        lambda s: metrics.ranking_metrics(s, ["grp"]).select("grp", "auprc")
    ),
    "v03_roc_auc": _by_group(lambda s: metrics.ranking_metrics(s, ["grp"]).select("grp", "auroc")),
    "v04_brier": _by_group(lambda s: metrics.brier(s, ["grp"])),
    "v05_pr_curve": _by_group(metrics.curve_points),
    "v06_threshold": _by_group(lambda s: metrics.best_threshold(s, 0.6, ["grp"])),
    "v06_threshold_strict": _by_group(lambda s: metrics.best_threshold(s, 0.95)),
    "v07_macro_one_vs_rest": _macro,
    "v08_min_max_score": lambda spark, sf: cast_all(
        metrics.rescaled_scores(
            table(spark, sf, "lineitem").select(
                (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row_key"),
                F.expr(DECISION).alias("decision"),
            ),
            "decision",
        )
    ),
    "v09_macro_f1": lambda spark, sf: cast_all(
        metrics.macro_f1(class_scores(spark, sf), "actual", "guess")
    ),
    "x12_extra_metrics": _by_group(
        lambda s: metrics.balanced_accuracy(s, 0.5, ["grp"]).join(
            metrics.log_loss(s, ["grp"]), "grp"
        )
    ),
}


def threshold_sql(floor: float, by: str) -> str:
    """Plain statement of the rule: every candidate against every score group."""
    g = f"{by}, " if by else ""
    part = f"partition by {by}" if by else ""
    same = f"and c.{by} = s.{by}" if by else ""
    groups = f"(select distinct {by} from x_scored)" if by else "(select 1 as one)"
    total = f"(select {g}sum(y) as p from x_scored{' group by 1' if by else ''})"
    return with_views(
        "x_scored",
        f"""with s as (select {g}score, sum(y) as pos, sum(1 - y) as neg from x_scored group by all),
 tot as {total},
 c as (
  select {g}least(greatest(score, 1e-9::double), 1 - 1e-9::double) as t from s
  union
  select {g}i / 100.0::double as t from {groups}, range(1, 100) r(i)),
 k as (
  select {'c.' + by + ', ' if by else ''}c.t, coalesce(sum(s.pos), 0) as tp, coalesce(sum(s.neg), 0) as fp
  from c left join s on s.score >= c.t {same} group by all),
 m as (
  select k.*, case when tp + fp = 0 then 0 else tp::double / (tp + fp) end as precision,
    tp::double / p as recall, 2.0::double * tp / (tp + fp + p) as f1
  from k {'join tot using (' + by + ')' if by else 'cross join tot'}),
 o as (
  select *, recall + 1e-12 >= {floor}::double as ok from m),
 b as (
  select *, row_number() over ({part} order by ok desc, case when ok then f1 else recall end desc,
    case when ok then 0 else f1 end desc, t) as rn from o)
select {g}round(t, 6) as threshold, round(precision, 6) as precision, round(recall, 6) as recall,
  round(f1, 6) as f1, cast(not ok as bigint) as violated from b where rn = 1""",
    )


OVR = f"""with {X_CLASS},
 u as (
  select 'A' as class, cast(actual = 'A' as bigint) as y, s_a as score from x_class
  union all select 'N', cast(actual = 'N' as bigint), s_n from x_class
  union all select 'R', cast(actual = 'R' as bigint), s_r from x_class),
 g as (select class, score, sum(y) as pos, sum(1 - y) as neg from u group by 1, 2),
 t as (
  select *, sum(pos) over w as cum_pos, sum(neg) over w as cum_neg,
    sum(pos) over (partition by class) as p, sum(neg) over (partition by class) as n
  from g window w as (partition by class order by score desc rows unbounded preceding)),
 m as (
  select class, sum(pos * (cum_pos::double / (cum_pos + cum_neg))) / max(p) as auprc,
    sum(pos * (n - cum_neg + neg / 2.0::double)) / (max(p)::double * max(n)) as auroc
  from t group by 1)
select round(avg(auprc), 6) as auprc, round(avg(auroc), 6) as auroc from m"""

SQL = {
    "v01_confusion": with_views(
        "x_scored",
        """with c as (
  select grp, count(*) filter (y = 0 and score < 0.5) as tn, count(*) filter (y = 0 and score >= 0.5) as fp,
    count(*) filter (y = 1 and score < 0.5) as fn, count(*) filter (y = 1 and score >= 0.5) as tp
  from x_scored group by 1)
select *, round(case when tp + fp = 0 then 0 else tp::double / (tp + fp) end, 6) as precision,
  round(case when tp + fn = 0 then 0 else tp::double / (tp + fn) end, 6) as recall,
  round(case when 2 * tp + fp + fn = 0 then 0 else 2.0::double * tp / (2 * tp + fp + fn) end, 6) as f1
from c""",
    ),
    "v02_average_precision": with_views(
        "x_scored",
        f"""with {TOTALS}
select grp, round(sum(pos * (cum_pos::double / (cum_pos + cum_neg))) / max(p), 6) as auprc
from t group by 1""",
    ),
    "v03_roc_auc": with_views(
        "x_scored",
        f"""with {TOTALS}
select grp, round(sum(pos * (n - cum_neg + neg / 2.0::double)) / (max(p)::double * max(n)), 6) as auroc
from t group by 1""",
    ),
    "v04_brier": with_views(
        "x_scored",
        "select grp, round(avg((score - y) * (score - y)), 6) as brier from x_scored group by 1",
    ),
    "v05_pr_curve": with_views(
        "x_scored",
        """with g as (select score, sum(y) as pos, sum(1 - y) as neg from x_scored group by 1),
 t as (
  select score, sum(pos) over w as tp, sum(neg) over w as fp, sum(pos) over () as p
  from g window w as (order by score desc rows unbounded preceding))
select round(score, 6) as threshold, round(tp::double / (tp + fp), 6) as precision,
  round(tp::double / p, 6) as recall from t""",
    ),
    "v06_threshold": threshold_sql(0.6, "grp"),
    "v06_threshold_strict": threshold_sql(0.95, ""),
    "v07_macro_one_vs_rest": OVR,
    "v08_min_max_score": f"""with d as (
  select l_orderkey * 10 + l_linenumber as row_key, {DECISION} as decision from lineitem)
select row_key, round(decision, 6) as decision,
  round((decision - min(decision) over ()) / (max(decision) over () - min(decision) over () + 1e-12), 6) as score
from d""",
    "v09_macro_f1": f"""with {X_CLASS}, {X_GUESS},
 k as (select unnest(['A', 'N', 'R']) as class),
 c as (
  select class, count(*) filter (actual = class and guess = class) as tp,
    count(*) filter (actual <> class and guess = class) as fp,
    count(*) filter (actual = class and guess <> class) as fn
  from k, x_guess group by 1)
select round(avg(case when 2 * tp + fp + fn = 0 then 0 else 2.0::double * tp / (2 * tp + fp + fn) end), 6) as f1
from c""",
    "x12_extra_metrics": with_views(
        "x_scored",
        """with p as (
  select grp, y, score, least(greatest(score, 1e-15::double), 1 - 1e-15::double) as q from x_scored)
select grp,
  round((count(*) filter (y = 1 and score >= 0.5)::double / count(*) filter (y = 1)
    + count(*) filter (y = 0 and score < 0.5)::double / count(*) filter (y = 0)) / 2, 6) as balanced_accuracy,
  round(avg(-case when y = 1 then ln(q) else ln(1 - q) end), 6) as log_loss
from p group by 1""",
    ),
}
