"""Model, search, selection, scoring and source queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.cohort import feature_table
from catalog.features import SQL as FEATURE_SQL
from catalog.features import visits
from catalog.metrics import CLASSES, X_CLASS, class_scores
from catalog.profile import SQL as PROFILE_SQL
from catalog.views import cast_all, header, scored, table, with_views
from tabml.functions.ordered import numbered
from tabml.operators import boosting, metrics, models, registry, score, split, tune
from tabml.operators.features import FeaturePlan
from tabml.operators.labels import class_label, index_label, is_positive, label_map
from tabml.plans import rules
from tabml.session import let_go, new_path, removed, staged
from tabml.sources import readers, writers

TARGET = "y_acute_90"

# ---------------------------------------------------------------- fitted models

def _splits(spark, sf):
    """Feature rows with their split, written once; the label is 0/1 already."""
    opts = split.SplitOptions(key=("person_id", "index_month"), label=TARGET)
    features, path = new_path(spark, "features"), new_path(spark, "splits")
    feature_table(spark, sf).write.parquet(features)
    let_go(spark)
    rows = split.split_rows(spark.read.parquet(features), opts).withColumn(models.ID, is_positive(F.col(TARGET), 1))
    writers.write_splits(rows, path)
    removed(spark, features)
    let_go(spark)
    return {s: writers.read_split(spark, path, s) for s in ("train", "val", "test")}


def _plan(df):
    return FeaturePlan.default(df, TARGET, drop=["person_id", "index_month", models.ID], scale=True)


def _search(spark, sf):
    s = _splits(spark, sf)
    plan = _plan(s["train"])
    board = models.search(
        s["train"].drop(models.ID), s["val"].drop(models.ID), plan,
        models.candidates(), parallelism=4,
    )
    return cast_all(board)


def _multiclass_search(spark, sf):
    """The line status of an order's rows from their numbers: three classes."""
    lines = table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row_key"), "l_partkey", "l_suppkey",
        "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linestatus", "l_returnflag",
    )
    opts = split.SplitOptions(key=("row_key", "l_partkey", "l_suppkey", "l_extendedprice"), method="random")
    rows = split.random_split(lines, opts)
    part = {s: rows.filter(F.col("split") == s).drop("split") for s in ("train", "val")}
    plan = FeaturePlan.default(lines, "l_returnflag", drop=["row_key", "l_partkey", "l_suppkey"])
    board = models.search(part["train"], part["val"], plan, models.candidates(), parallelism=4)
    return cast_all(board)


def _final(spark, sf):
    s = _splits(spark, sf)
    board, _ = models.evaluate(
        s["train"], s["val"], s["test"], _plan(s["train"]), models.candidates(), parallelism=4
    )
    return cast_all(board)


def _tuned(spark, sf):
    s = _splits(spark, sf)
    data = models.prepare(s["train"].drop(models.ID), s["val"].drop(models.ID), _plan(s["train"]))
    space = tune.space_table(spark, tune.DEFAULT_SPACE)
    finished = tune.tune(data, list(tune.TUNED), space, trials=tune.TRIALS, parallelism=8, prune=True)
    best = tune.best_trials(finished)
    return best.select("model", "trial", F.to_json("params").alias("params"), "best_value")


def _cross_validated(spark, sf):
    """A row per preset and fold of the feature rows."""
    rows = staged(feature_table(spark, sf), "features")
    plan = FeaturePlan.default(rows, TARGET, drop=["person_id", "index_month"], scale=True)
    board = models.cross_validate(rows, plan, models.candidates(), ("person_id", "index_month"), parallelism=4)
    return cast_all(board)


def _regression_search(spark, sf):
    """The price of a line from its other numbers and its flags."""
    lines = table(spark, sf, "lineitem").drop("l_shipdate")
    opts = split.SplitOptions(key=tuple(lines.columns), method="random")
    rows = staged(split.random_split(lines, opts), "lines")
    part = {s: rows.filter(F.col("split") == s).drop("split") for s in ("train", "val")}
    plan = FeaturePlan.default(lines, "l_extendedprice", drop=["l_orderkey", "l_partkey", "l_suppkey"], scale=True)
    chosen = {"elasticnet": {}, "xgboost": {}, "lightgbm": {"lambda_l1": 1.0, "lambda_l2": 1.0}}
    return cast_all(models.regression_search(part["train"], part["val"], plan, chosen, parallelism=3))


def _residuals(spark, sf):
    made = table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("flag"), F.col("l_extendedprice").alias("y"),
        F.expr("case when l_orderkey % 11 <> 0 then l_quantity * 1000 + l_linenumber end").alias("score"),
    )
    return metrics.residuals(made, ["flag"])


def _median_rule(spark, sf):
    """Made trials: a supplier's mean discount and tax stand for its values after 50 and 100 rounds."""
    values = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        F.sum(F.round(F.col("l_discount") * 100).cast("long")).cast("double").alias("early"),
        F.sum(F.round(F.col("l_tax") * 100).cast("long")).cast("double").alias("late"),
    )
    at = F.when(F.col("l_suppkey") % 4 == 0, 50).otherwise(100)
    fits = values.select(
        F.col("l_suppkey").alias("key"), (F.col("l_suppkey") % 3).cast("string").alias("group_of"), at.alias("rounds"),
        F.when(at == 50, F.col("early")).otherwise(F.col("late")).alias("value"),
        (F.col("l_suppkey") % 5 == 0).alias("done"), F.lit(False).alias("stopped"),
        F.when(at == 50, F.create_map(F.lit("50"), F.col("early")))
        .otherwise(F.create_map(F.lit("50"), F.col("early"), F.lit("100"), F.col("late"))).alias("history"),
    )
    return boosting.behind_median(fits, 3, 1, 50).drop("history")


def _dense_ids(spark, sf):
    """The numbers that rows without an id get, here in an order that SQL has as well."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    whole = numbered(orders, ["o_custkey", "o_orderkey"], name="row_id")
    return numbered(whole, ["o_totalprice", "o_orderkey"], ["o_orderstatus"], "in_status")


def _scored_batch(spark, sf):
    """Fit, evaluate, select, register, then load the registered version and score with it."""
    s = _splits(spark, sf)
    plan = _plan(s["train"])
    board, fitted = models.evaluate(s["train"], s["val"], s["test"], plan, models.candidates(), parallelism=4)
    reg = registry.Registry(spark, new_path(spark, "registry"))
    paths = {}
    for name, model in fitted.items():
        paths[name] = new_path(spark, f"model-{name}")
        model.write().save(paths[name])
    board = staged(board, "leaderboard")
    reg.log_leaderboard(board, "acute", paths, "first")
    reg.register(registry.select_model(board), "acute-model")
    serving = reg.serving("acute-model")
    model = models.PipelineModel.load(serving["model_path"])
    # The whole input is scored, without an id: a person has many months.
    rows = s["train"].unionByName(s["val"]).unionByName(s["test"]).drop(models.ID)
    return score.batch_score(model, rows, serving["threshold"], None, TARGET)


# ---------------------------------------------------------------- made scorers

NAMES = ("alpha", "beta", "gamma", "delta")
SCORES = {
    "alpha": "(cast(l_quantity as bigint) + 17 * y + 3 * l_linenumber) % 91 / 91.0{d}",
    "beta": "(cast(l_quantity as bigint) * 7 + 31 * y) % 97 / 97.0{d}",
    "gamma": "(cast(l_quantity as bigint) + 40 * y) / 128.0{d}",
    "delta": "l_partkey % 83 / 83.0{d}",
}
FLAG = "case when l_returnflag = 'R' then 1 else 0 end"


def _scores(spark, sf):
    """Line items scored by four formulas: stand-ins for fitted models with known scores."""
    lines = table(spark, sf, "lineitem").withColumn("y", F.expr(FLAG))
    made = F.array(
        *[
            F.struct(F.lit(n).alias("name"), F.expr(SCORES[n].format(d="D")).alias("score"))
            for n in NAMES
        ]
    )
    return lines.select(
        "y", F.year("l_shipdate").alias("year"), F.col("l_shipdate").alias("at"),
        F.when(F.col("l_linenumber") <= 3, "val").otherwise("test").alias("part"),
        F.explode(made).alias("m"),
    ).select("y", "year", "at", "part", "m.name", "m.score")


def _board(spark, sf, floor=0.6):
    rows = _scores(spark, sf)
    return models.final_leaderboard(
        rows.filter("part = 'val'"), rows.filter("part = 'test'"), floor
    )


def _runs(spark, sf):
    """One run per scorer and ship year, evaluated at 0.5 on that year's rows."""
    rows = _scores(spark, sf)
    by = ["name", "year"]
    points = metrics.confusion(rows, 0.5, by).join(metrics.ranking_metrics(rows, by), by)
    times = rows.groupBy(*by).agg(F.max("at").alias("start_time"))
    return points.join(times, by).select(
        F.concat_ws("-", "name", "year").alias("run_id"),
        F.concat(F.lit("final_"), "name").alias("run_name"),
        "start_time",
        *[F.col(m).alias(f"test_{m}") for m in registry.METRICS],
        F.when(F.col("year") % 2 == 0, F.col("precision")).alias("threshold"),
    )


def _versions(spark, sf):
    """Every run is a version of its scorer, numbered by year; some carry a threshold."""
    rows = _scores(spark, sf)
    ends = rows.groupBy("name", "year").agg(F.max("score").alias("top"))
    return ends.select(
        F.col("name").alias("model"),
        (F.col("year") - 1990).cast("string").alias("version"),
        F.concat_ws("-", "name", "year").alias("run_id"),
        F.when(F.col("name") == "alpha", F.format_string("%.4f", F.col("top"))).alias("decision_threshold"),
    )


def _selected(spark, sf, floor):
    return registry.select_model(_board(spark, sf), "auprc", floor)


def _closest(spark, sf):
    return registry.closest_run(_runs(spark, sf), _selected(spark, sf, 0.6)).select(
        "run_id", "run_name", "start_time", "distance"
    )


def _newest(spark, sf):
    runs = _runs(spark, sf)
    return registry.newest_run(runs, "final_beta").select("run_id", "run_name", "start_time")


def _report(spark, sf):
    board = _board(spark, sf)
    return score.report_table(board, registry.select_model(board, "auprc", 0.6))


def _trials(spark, sf):
    space = rules.search_space(visits(spark, sf)).filter("only_if").drop("only_if")
    space = space.withColumn("choices", F.lit(None).cast("array<string>"))
    return tune.sample_trials(space, 20).drop("choice")


def _argmax(spark, sf):
    rows = class_scores(spark, sf)
    label, top = score.predicted(F.array(*[F.col(f"s_{k}") for k in CLASSES]), 0.5)
    return rows.select(label.alias("prediction"), top.alias("score"), "actual")


def _post_score(spark, sf):
    rows = scored(spark, sf).withColumn("target", F.when(F.col("y") == 1, "1.0").otherwise("0"))
    return score.post_score_metrics(rows, "target", 1, 0.4)


# ---------------------------------------------------------------- sources and sinks


def _parquet_trip(spark, sf):
    path = writers.write_dataset(table(spark, sf, "customer"), new_path(spark, "trip"), "fixed")
    return cast_all(readers.load_source(spark, "file", path=path))


def _csv_trip(spark, sf):
    path = new_path(spark, "trip")  # no extension: the reader has to find out
    writers.write_csv(table(spark, sf, "orders"), path)
    return readers.read_file(spark, path).select(
        F.col("o_orderkey").cast("bigint").alias("o_orderkey"),
        F.col("o_custkey").cast("bigint").alias("o_custkey"),
        "o_orderstatus", "o_totalprice", F.col("o_orderdate").cast("timestamp_ntz").alias("o_orderdate"), "o_orderpriority",
    )


def _all_text(spark, sf):
    path = new_path(spark, "text")
    writers.write_csv(header(spark, sf), path)
    types = {c: "bigint" for c in ("claim_id", "person_id", "provider_id")}
    types |= {c: "date" for c in ("service_from", "service_thru")}
    types |= {f"{c}_amount": "double" for c in ("allowed", "copay", "coinsurance", "deductible")}
    return cast_all(readers.typed(readers.load_source(spark, "text", path=path), types))


def _timestamps(spark, sf):
    """Named columns of an all-text table parsed as it is read."""
    path = new_path(spark, "text")
    writers.write_csv(header(spark, sf).select("claim_id", "service_from", "claim_type"), path)
    rows = readers.with_timestamps(readers.read_text_table(spark, path), ["service_from", "no_such_column"])
    return rows.select(F.col("claim_id").cast("bigint").alias("claim_id"), "service_from", "claim_type")


def _preview_trip(spark, sf):
    path = new_path(spark, "preview")
    v = visits(spark, sf)
    writers.write_preview(v, ["claim_id"], path, 100)
    return cast_all(readers.read_csv(spark, path, v.schema.simpleString()[7:-1].replace(":", " ")))


def _json_trip(spark, sf):
    path = new_path(spark, "json")
    summary = score.post_score_metrics(scored(spark, sf).withColumn("target", F.col("y").cast("string")), "target", 1, 0.4)
    writers.write_json(summary, path)
    return cast_all(spark.read.schema(summary.schema).json(path))


def _prediction_trip(spark, sf):
    path = writers.write_predictions(_argmax(spark, sf), new_path(spark, "sink"), "fixed")
    return cast_all(spark.read.parquet(path))


def _split_trip(spark, sf):
    path = new_path(spark, "splits")
    opts = split.SplitOptions(key=("o_orderkey",), label="o_orderstatus")
    writers.write_splits(split.random_split(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), opts), path)
    return writers.read_split(spark, path, "train", "val")


def _made_trials(spark, sf):
    """Trials with known values, some without, many tied: the best of each model."""
    trials = table(spark, sf, "orders").select(
        F.col("o_orderstatus").alias("model"), F.col("o_orderkey").alias("trial"),
        F.create_map(F.lit("k"), F.col("o_custkey").cast("string")).alias("params"),
        F.expr("case when o_orderkey % 7 <> 0 then o_custkey % 50 / 64.0D end").alias("value"),
    )
    best = tune.best_trials(trials)
    return best.select("model", "trial", F.col("params")["k"].alias("k"), "best_value")


def _new_version(spark, sf):
    """The row that registering the selected scorer appends, after versions 1 to 10."""
    versions = _versions(spark, sf)
    chosen = _selected(spark, sf, 0.6)
    number = registry.next_version(versions, "alpha")
    return registry.version_row(chosen, registry.closest_run(_runs(spark, sf), chosen), "alpha", number)


def _stored_labels(spark, sf):
    """The label map of finished orders, stored with a run, read back and applied to all orders."""
    orders = table(spark, sf, "orders").select("o_orderstatus", "o_orderpriority")
    reg = registry.Registry(spark, new_path(spark, "registry"))
    done = orders.filter("o_orderstatus = 'F' and o_orderpriority <> '3-MEDIUM'")
    reg.log_labels("first", label_map(done, "o_orderpriority"), "string")
    classes = reg.labels("first")
    counts = index_label(orders, "o_orderpriority", classes).groupBy("class_id").agg(F.count(F.lit(1)).alias("n"))
    return class_label(counts, classes, "string", "class_id")


def _q(build):
    return lambda spark, sf: cast_all(build(spark, sf))


QUERIES = {
    "m01_search": _search,
    "m01_search_multiclass": _multiclass_search,
    "m03_final_leaderboard": _final,
    "m03_leaderboard_of_scores": _q(_board),
    "h01_sampled_trials": _q(_trials),
    "h02_tuned_best": _tuned,
    "s01_select": _q(lambda spark, sf: _selected(spark, sf, 0.6)),
    "s01_select_fallback": _q(lambda spark, sf: _selected(spark, sf, 0.99999)),
    "s02_closest_run": _q(_closest),
    "s02_newest_run": _newest,
    "s03_serving_threshold": _q(
        lambda spark, sf: registry.serving_threshold(_versions(spark, sf), _runs(spark, sf))
    ),
    "s04_report": _q(_report),
    "h03_cross_validated": _cross_validated,
    "h04_median_rule": _q(_median_rule),
    "m04_regression_search": _regression_search,
    "m04_regression_metrics": _q(_residuals),
    "d01_batch_score": _scored_batch,
    "d01_dense_ids": _dense_ids,
    "d02_post_score_metrics": _q(_post_score),
    "d03_argmax": _q(_argmax),
    "i01_parquet_round_trip": _parquet_trip,
    "i02_csv_round_trip": _csv_trip,
    "i03_manifest": _q(lambda spark, sf: writers.manifest(table(spark, sf, "lineitem"))),
    "i04_all_text": _all_text,
    "i05_preview_csv": _preview_trip,
    "i06_json_summary": _json_trip,
    "i07_predictions": _prediction_trip,
    "i08_split_tables": _split_trip,
    "i09_named_timestamps": _timestamps,
    "h02_best_of_made_trials": _made_trials,
    "s05_new_version": _q(_new_version),
    "s06_stored_labels": _q(_stored_labels),
}

# ---------------------------------------------------------------- comparison SQL

X_SCORES = "x_scores as (" + "\n union all ".join(
    f"""select y, year(l_shipdate) as year, l_shipdate as at_time,
    case when l_linenumber <= 3 then 'val' else 'test' end as part, '{n}' as name,
    {SCORES[n].format(d='::double')} as score
  from (select *, {FLAG} as y from lineitem)"""
    for n in NAMES
) + ")"


def _ranking(name: str, source: str, by: str) -> str:
    """CTEs up to ``name`` with auprc and auroc per group."""
    return f"""{name}_g as (select {by}, score, sum(y) as pos, sum(1 - y) as neg from {source} group by all),
 {name}_t as (
  select *, sum(pos) over w as cp, sum(neg) over w as cn, sum(pos) over (partition by {by}) as p,
    sum(neg) over (partition by {by}) as n
  from {name}_g window w as (partition by {by} order by score desc rows unbounded preceding)),
 {name} as (
  select {by}, sum(pos * (cp::double / (cp + cn))) / max(p) as auprc,
    sum(pos * (n - cn + neg / 2.0::double)) / (max(p)::double * max(n)) as auroc
  from {name}_t group by {by})"""


RATES = """case when tp + fp = 0 then 0 else tp::double / (tp + fp) end as precision,
    case when tp + fn = 0 then 0 else tp::double / (tp + fn) end as recall,
    case when 2 * tp + fp + fn = 0 then 0 else 2.0::double * tp / (2 * tp + fp + fn) end as f1"""
COUNTS = """count(*) filter (y = 0 and score < {t}) as tn, count(*) filter (y = 0 and score >= {t}) as fp,
    count(*) filter (y = 1 and score < {t}) as fn, count(*) filter (y = 1 and score >= {t}) as tp"""

BOARD = f"""{X_SCORES},
 vs as (select name, score, sum(y) as pos, sum(1 - y) as neg from x_scores where part = 'val' group by 1, 2),
 vp as (select name, sum(pos) as p from vs group by 1),
 vc as (
  select name, least(greatest(score, 1e-9::double), 1 - 1e-9::double) as t from vs
  union select name, i / 100.0::double from vp, range(1, 100) r(i)),
 vk as (
  select vc.name, vc.t, coalesce(sum(vs.pos), 0) as tp, coalesce(sum(vs.neg), 0) as fp
  from vc left join vs on vs.name = vc.name and vs.score >= vc.t group by 1, 2),
 vm as (
  select vk.name, t, tp::double / p as recall, 2.0::double * tp / (tp + fp + p) as f1,
    tp::double / p + 1e-12 >= 0.6::double as ok from vk join vp using (name)),
 cut as (
  select name, t as threshold, not ok as violated from (
    select *, row_number() over (partition by name order by ok desc, case when ok then f1 else recall end desc,
      case when ok then 0 else f1 end desc, t) as rn from vm) where rn = 1),
 ts as (select * from x_scores where part = 'test'),
 tc as (
  select ts.name, threshold, violated, {COUNTS.format(t='threshold')}
  from ts join cut using (name) group by all),
 {_ranking('tr', 'ts', 'name')},
 board as (
  select tc.name, round(threshold, 6) as threshold, cast(violated as bigint) as violated, tn, fp, fn, tp,
    {RATES}, auprc, auroc from tc join tr using (name))"""
ROUNDED = "round(auprc, 6) as auprc, round(auroc, 6) as auroc, round(precision, 6) as precision, round(recall, 6) as recall, round(f1, 6) as f1"
CHOSEN = """chosen as (
  select board.*, 'auprc' as primary_metric, {floor}::double as min_recall,
    count(*) filter (recall >= {floor}) over () as filtered_count, count(*) over () as total_count
  from board qualify row_number() over (
    order by coalesce(recall >= {floor}, false) desc, auprc desc, f1 desc, name desc) = 1)"""
RUNS = f"""rc as (select name, year, max(at_time) as start_time, {COUNTS.format(t='0.5::double')}
  from x_scores group by 1, 2),
 {_ranking('rr', 'x_scores', 'name, year')},
 runs as (
  select name || '-' || year as run_id, 'final_' || name as run_name, start_time, auprc, auroc, {RATES},
    case when year % 2 = 0 then precision end as threshold
  from rc join rr using (name, year))"""


def _select_sql(floor: float) -> str:
    return f"""with {BOARD}, {CHOSEN.format(floor=floor)}
select name, threshold, violated, tn, fp, fn, tp, {ROUNDED}, primary_metric, round(min_recall, 6) as min_recall,
  filtered_count, total_count, cast(filtered_count > 0 as bigint) as used_recall_filter from chosen"""


def _trial_sql() -> str:
    from catalog.profile import SQL as profiles

    u = "('0x' || substr(md5(concat_ws('-', '42', trial, model, param)), 1, 8))::bigint / 4294967296.0::double"
    return f"""with space as (select * from ({profiles['p04_search_space']}) where only_if = 1),
 t as (select space.*, i as trial from space, range(20) r(i)),
 v as (select *, {u} as u from t)
select model, trial, param, round(case kind when 'int' then floor(low + u * (high - low + 1))
  when 'float' then low + u * (high - low)
  when 'loguniform' then exp(ln(low) + u * (ln(high) - ln(low))) end, 6) as value from v"""


D03 = f"""with {X_CLASS}
select actual, cast(case when s_a = greatest(s_a, s_n, s_r) then 0 when s_n = greatest(s_a, s_n, s_r) then 1
  else 2 end as bigint) as prediction, round(greatest(s_a, s_n, s_r), 6) as score from x_class"""


D02 = with_views(
        "x_scored",
        f"""with c as (select {COUNTS.format(t='0.4::double')} from x_scored),
 one as (select 1 as k, y, score from x_scored),
 {_ranking('r', 'one', 'k')}
select tn, fp, fn, tp, {', '.join(f'round({m}, 6) as {m}' for m in ('precision', 'recall', 'f1'))},
  0.4::double as threshold, round(auprc, 6) as auprc, round(auroc, 6) as auroc
from (select c.*, {RATES} from c), r""",
    )

SQL = {
    "s06_stored_labels": """
with m as (
  select label, row_number() over (order by label) - 1 as class_id from (
    select distinct o_orderpriority as label from orders
    where o_orderstatus = 'F' and o_orderpriority <> '3-MEDIUM'))
select class_id, label, count(*) as n from orders left join m on o_orderpriority = label group by all""",
    "d01_dense_ids": """
select o_orderkey, o_custkey, o_orderstatus, o_totalprice, row_number() over (order by o_custkey, o_orderkey) - 1 as row_id,
  row_number() over (partition by o_orderstatus order by o_totalprice, o_orderkey) - 1 as in_status
from orders""",
    "m04_regression_metrics": """
with m as (
  select l_returnflag as flag, l_extendedprice as y, l_quantity * 1000 + l_linenumber as score
  from lineitem where l_orderkey % 11 <> 0)
select flag, count(*) as n, round(sqrt(avg((y - score) * (y - score))), 6) as rmse, round(avg(abs(y - score)), 6) as mae,
  round(1 - sum((y - score) * (y - score)) / sum((y - mean) * (y - mean)), 6) as r2
from m join (select flag, avg(y) as mean from m group by flag) using (flag) group by flag""",
    "h04_median_rule": """
with v as (
  select l_suppkey as key, l_suppkey % 3 as g, sum(round(l_discount * 100)::bigint)::double as early,
    sum(round(l_tax * 100)::bigint)::double as late, case when l_suppkey % 4 = 0 then 50 else 100 end as rounds
  from lineitem group by l_suppkey),
 m as (
  select g, 50 as rounds, median(early) as middle, count(*) as n from v group by g
  union all select g, 100, median(late), count(*) from v where rounds = 100 group by g),
 j as (select v.*, case when rounds = 50 then early else late end as value, middle, n from v join m using (g, rounds))
select key, g::varchar as group_of, rounds::bigint as rounds, value,
  (key % 5 = 0 or (n >= 3 and value < middle))::bigint as done,
  (key % 5 <> 0 and n >= 3 and value < middle)::bigint as stopped
from j""",
    "m03_leaderboard_of_scores": f"""with {BOARD}
select name, threshold, violated, tn, fp, fn, tp, {ROUNDED} from board""",
    "h01_sampled_trials": _trial_sql(),
    "s01_select": _select_sql(0.6),
    "s01_select_fallback": _select_sql(0.99999),
    "s02_closest_run": f"""with {BOARD}, {CHOSEN.format(floor=0.6)}, {RUNS}
select run_id, run_name, runs.start_time, round((runs.auprc - c.auprc) ** 2 + (runs.auroc - c.auroc) ** 2
  + (runs.precision - c.precision) ** 2 + (runs.recall - c.recall) ** 2 + (runs.f1 - c.f1) ** 2, 6) as distance
from runs join chosen c on run_name = 'final_' || c.name
order by (runs.auprc - c.auprc) ** 2 + (runs.auroc - c.auroc) ** 2 + (runs.precision - c.precision) ** 2
  + (runs.recall - c.recall) ** 2 + (runs.f1 - c.f1) ** 2, runs.start_time desc, run_id limit 1""",
    "s02_newest_run": f"""with {X_SCORES}, {RUNS}
select run_id, run_name, start_time from runs where run_name = 'final_beta'
order by start_time desc, run_id limit 1""",
    "s03_serving_threshold": f"""with {X_SCORES}, {RUNS},
 versions as (
  select name as model, cast(year - 1990 as varchar) as version, name || '-' || year as run_id,
    case when name = 'alpha' then printf('%.4f', max(score)) end as decision_threshold
  from x_scores group by name, year)
select model, version, v.run_id, round(coalesce(try_cast(decision_threshold as double), threshold, 0.5), 6) as threshold
from versions v left join runs on runs.run_id = v.run_id
qualify row_number() over (partition by model order by version::int desc) = 1""",
    "s04_report": f"""with {BOARD}, {CHOSEN.format(floor=0.6)}
select board.name, threshold, tn, fp, fn, tp, {ROUNDED},
  cast(board.name = (select name from chosen) as bigint) as selected,
  cast(recall >= 0.6 as bigint) as meets_recall, violated as threshold_violated, 'auprc' as primary_metric
from board""",
    "d02_post_score_metrics": D02,
    "i06_json_summary": D02,
    "d03_argmax": D03,
    "i01_parquet_round_trip": "select * replace (cast(c_nationkey as bigint) as c_nationkey) from customer",
    "i02_csv_round_trip": "select * from orders",
    "h02_best_of_made_trials": """select o_orderstatus as model, o_orderkey as trial, cast(o_custkey as varchar) as k,
  o_custkey % 50 / 64.0::double as best_value from orders where o_orderkey % 7 <> 0
qualify row_number() over (partition by o_orderstatus order by o_custkey % 50 desc, o_orderkey) = 1""",
    "s05_new_version": f"""with {BOARD}, {CHOSEN.format(floor=0.6)}, {RUNS},
 near as (
  select run_id from runs join chosen c on run_name = 'final_' || c.name
  order by (runs.auprc - c.auprc) ** 2 + (runs.auroc - c.auroc) ** 2 + (runs.precision - c.precision) ** 2
    + (runs.recall - c.recall) ** 2 + (runs.f1 - c.f1) ** 2, runs.start_time desc, run_id limit 1),
 top as (select max(year - 1990) + 1 as version from x_scores where name = 'alpha')
select 'alpha' as model, cast(version as varchar) as version, run_id, name as alias,
  printf('%.6f', threshold) as decision_threshold, primary_metric, round(min_recall, 6) as min_recall,
  {", ".join(f"round({m}, 6) as test_{m}" for m in registry.METRICS)}
from chosen, near, top""",
    "i05_preview_csv": PROFILE_SQL["e12_preview"],
    "i07_predictions": D03,
    "i08_split_tables": f"select o_orderkey, o_orderstatus from ({FEATURE_SQL['f09_random_split']}) where split <> 'test'",
    "i09_named_timestamps": with_views(
        "x_header", "select claim_id, try_cast(service_from as timestamp) as service_from, claim_type from x_header"
    ),
    "i03_manifest": """select count(*) as n_rows, 11::bigint as n_cols,
  'l_orderkey,l_partkey,l_suppkey,l_linenumber,l_quantity,l_extendedprice,l_discount,l_tax,l_returnflag,l_linestatus,l_shipdate'
    as "columns" from lineitem""",
    "i04_all_text": with_views(
        "x_header",
        """select claim_id, person_id, try_cast(service_from as date) as service_from,
  try_cast(service_thru as date) as service_thru, claim_type, drg, bill_type, provider_id, """
        + ", ".join(f"round(try_cast({c}_amount as double), 6) as {c}_amount" for c in ("allowed", "copay", "coinsurance", "deductible"))
        + " from x_header",
    ),
}
