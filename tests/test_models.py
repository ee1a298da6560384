import datetime as dt
import json
import threading

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tabml.operators import labels, models, registry, score, tune
from tabml.operators.features import FeaturePlan
from tabml.plans import rules
from tabml.session import ADVISORY, new_path, small_tasks, work_dir


@pytest.fixture(scope="module")
def data(spark):
    df = spark.range(900).select(
        "id",
        (F.pmod(F.hash("id"), F.lit(100)) / 100).alias("x"),
        F.when(F.col("id") % 3 == 0, "u").otherwise("v").alias("c"),
    )
    y = (F.col("x") + F.when(F.col("c") == "u", 0.3).otherwise(0.0) > 0.7).cast("int")
    df = df.withColumn("y", y).cache()
    part = F.col("id") % 10
    return df.filter(part < 6), df.filter((part >= 6) & (part < 8)), df.filter(part >= 8)


PLAN = FeaturePlan("y", ["x"], ["c"], [])
SMALL = {
    "logreg": {"max_iter": 20},
    "xgb": {"n_estimators": 3, "max_depth": 3},
    "lgbm": {"n_estimators": 5, "num_leaves": 8},
}


def test_search_ranks_and_survives_a_failing_candidate(data):
    train, val, _ = data
    chosen = [models.Candidate(n, p) for n, p in SMALL.items()]
    chosen.append(models.Candidate("xgb", {"learning_rate": -1}))
    chosen[-1] = models.Candidate("cat", {"learning_rate": -1})
    board = models.search(train, val, PLAN, chosen).collect()
    assert [r["name"] for r in board][-1] == "cat"
    assert board[-1]["auprc"] is None and board[-1]["fit_error"]
    assert all(r["auprc"] > 0.9 for r in board[:-1])
    assert board[0]["auprc"] >= board[1]["auprc"]


def test_rows_with_unseen_labels_are_left_out(spark):
    train = spark.createDataFrame([(float(i), "a" if i % 2 else "b") for i in range(40)], "x double, y string")
    val = spark.createDataFrame([(1.0, "a"), (2.0, "b"), (3.0, "new")], "x double, y string")
    data = models.prepare(train, val, FeaturePlan("y", ["x"]))
    assert data.classes == ["a", "b"] and data.val.count() == 2


def test_multiclass(spark):
    df = spark.range(300).select(
        (F.col("id") % 3 + F.rand(1) / 2).alias("x"), F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (F.col("id") % 3 + 1).cast("int")).alias("y")
    )
    names = [models.Candidate("lgbm", SMALL["lgbm"]), models.Candidate("xgb", SMALL["xgb"])]
    board = models.search(df, df, FeaturePlan("y", ["x"]), names).collect()
    assert all(r["auprc"] > 0.9 and r["f1"] > 0.9 for r in board)


def test_evaluate_select_register_score(spark, data):
    train, val, test = [d.withColumn("class_id", F.col("y")) for d in data]
    chosen = [models.Candidate("logreg", SMALL["logreg"]), models.Candidate("lgbm", SMALL["lgbm"])]
    board, fitted = models.evaluate(train, val, test, PLAN, chosen)
    board = board.cache()
    reg = registry.Registry(spark, new_path(spark, "registry"))
    with pytest.raises(LookupError):
        reg.serving("m")
    path = {}
    for name, model in fitted.items():
        path[name] = new_path(spark, name)
        model.write().save(path[name])
    reg.log_leaderboard(board, "exp", path, "r1")
    selected = registry.select_model(board)
    assert reg.register(selected, "m") == 1
    assert reg.register(selected, "m") == 2
    serving = reg.serving("m")
    assert serving["version"] == "2"
    assert serving["threshold"] == pytest.approx(selected.first()["threshold"], abs=1e-6)
    out = score.batch_score(PipelineModel.load(serving["model_path"]), test, serving["threshold"], "id", "y")
    assert out.columns == ["id", "prediction", "score", "threshold", "y"]
    points = score.post_score_metrics(out, "y", 1, serving["threshold"]).first()
    assert points["recall"] == pytest.approx(selected.first()["recall"])
    assert points["auprc"] == pytest.approx(selected.first()["auprc"])
    unnamed = score.batch_score(fitted["logreg"], test, 0.5)
    assert unnamed.select("row_id").distinct().count() == test.count()
    again = score.batch_score(fitted["logreg"], test.repartition(7), 0.5)
    assert set(map(tuple, again.collect())) == set(map(tuple, unnamed.collect()))


def test_tuning(spark, data):
    train, val, _ = data
    prepared = models.prepare(train, val, PLAN)
    space = tune.space_table(spark, {"logreg": {"C": {"loguniform": [0.01, 10.0]}, "max_iter": [5, 10]}})
    done = tune.tune(prepared, ["logreg", "cat"], space, trials=4, parallelism=2, patience=2)
    best = tune.best_trials(done).collect()
    assert [b["model"] for b in best] == ["logreg"]
    assert best[0]["best_value"] == max(r["value"] for r in done.collect())
    assert tune.as_candidate(best[0]).params["C"] > 0


def test_a_failing_trial_gives_a_row(data):
    train, val, _ = data
    prepared = models.prepare(train, val, PLAN)
    space = tune.space_table(train.sparkSession, {"logreg": {"max_iter": {"categorical": ["10.0", "-3"]}}})
    done = tune.tune(prepared, ["logreg"], space, trials=6, parallelism=2).collect()
    bad = [r for r in done if r["params"]["max_iter"] == "-3"]
    good = [r for r in done if r["params"]["max_iter"] == "10.0"]
    assert len(done) == 6 and bad and good
    assert all(r["value"] is None and r["fit_error"] for r in bad)
    assert all(r["value"] > 0.5 and r["fit_error"] is None for r in good)


def _settings(name, params):
    made = models.estimator(models.Candidate(name, params), 2, 1000)
    return {p.name: v for p, v in made.extractParamMap().items()}


def test_every_sampled_parameter_reaches_the_estimator():
    spaces = [(rules.MODEL_NAMES[m], p, lo, hi) for m, p, _, lo, hi in rules.SPACE if m in rules.CLASSIFIERS]
    spaces += [("lgbm", "min_data_in_leaf", 10.0, 20.0)]
    for name, params in tune.DEFAULT_SPACE.items():
        for p, spec in params.items():
            kind, lo, hi, choices = tune.parse_spec(spec)
            if kind != "choice":
                spaces.append((name, p, lo, hi))
    for name, p, lo, hi in spaces:
        lo = max(lo, 2.0) if p == "max_depth" else lo
        assert _settings(name, {p: lo}) != _settings(name, {p: (lo + hi) / 2}), (name, p)


def test_unknown_parameters_are_refused():
    for name, p in (("xgb", "booster"), ("lgbm", "max_bin"), ("cat", "border_count"), ("logreg", "penalty")):
        with pytest.raises(ValueError, match=p):
            models.Candidate(name, {p: 1.0}).merged()


def test_evaluation_settings():
    assert rules.evaluation_settings("regression")["primary_metric"] == "rmse"
    binary = rules.evaluation_settings("binary", floor=0.7, secondary=["f1"])
    assert binary == {"primary_metric": "auprc", "secondary_metrics": ["f1"], "tune_threshold": True, "min_recall": 0.7}
    assert rules.primary_metric("a", None, "c") == "a" and rules.primary_metric("a", "b") == "b" and rules.primary_metric() == "auprc"


def test_plan_blocks_become_candidates(spark):
    df = spark.range(100).select((F.col("id") % 10 == 0).cast("int").alias("y"), "id")
    blocks = {r["model"]: r for r in rules.model_blocks(df, "y").collect()}
    chosen = models.candidates([
        {"name": m, "only_if": b["only_if"], "fit_params": json.loads(b["fit_params"])} for m, b in blocks.items()
    ])
    rules_of = {c.name: models.weight_rule(c.merged()) for c in chosen}
    assert rules_of == {"lgbm": ("balanced", 0.0), "xgb": ("positive", 9.0), "cat": ("balanced", 0.0), "logreg": ("balanced", 0.0)}
    small = rules.Policies(small_rows=50)
    assert not {r["model"]: r["only_if"] for r in rules.model_blocks(df, "y", policies=small).collect()}["catboost"]
    assert {r["fit_params"] for r in rules.model_blocks(df, "y", "regression").collect()} == {"{}"}


def test_space_specs(spark):
    with pytest.raises(ValueError):
        tune.parse_spec({"low": True, "high": False})
    with pytest.raises(ValueError):
        tune.parse_spec({"log": True})
    assert tune.parse_spec([3, 10]) == ("int", 3.0, 10.0, None)
    assert tune.parse_spec([0.5, 1]) == ("float", 0.5, 1.0, None)
    assert tune.parse_spec([True, False])[0] == "choice"
    assert tune.parse_spec({"low": 1, "high": 8, "log": True})[0] == "logint"
    assert tune.parse_spec({"categorical": [None, "balanced"]}) == ("choice", None, None, [None, "balanced"])
    assert tune.parse_spec(7) == ("fixed", None, None, ["7"])
    plan = tune.space_table(spark, {"xgb": {"max_depth": [4, 5]}})
    both = tune.overlay(tune.space_table(spark, tune.DEFAULT_SPACE), plan)
    assert both.filter("model = 'xgb' and param = 'max_depth'").first()["high"] == 5.0
    trials = tune.sample_trials(both, 50)
    depth = [r["value"] for r in trials.filter("param = 'max_depth'").collect()]
    assert set(depth) == {4.0, 5.0}
    rates = [r["value"] for r in trials.filter("param = 'learning_rate'").collect()]
    assert all(1e-3 <= v <= 0.2 for v in rates)


def test_candidates_from_plan():
    chosen = models.candidates([{"name": "XGBoost"}, {"name": "other"}, {"name": "catboost", "only_if": False}, {"name": "linear"}])
    assert [c.name for c in chosen] == ["xgb", "logreg"]
    assert [c.name for c in models.candidates([])] == ["logreg", "xgb", "lgbm", "cat"]


def test_weight_rule():
    assert models.weight_rule({"scale_pos_weight": 4.0, "is_unbalance": True}) == ("positive", 4.0)
    assert models.weight_rule({"scale_pos_weight": 1, "is_unbalance": True}) == ("balanced", 0.0)
    assert models.weight_rule({"is_unbalance": False}) is None


def test_limits_of_trees():
    assert models._limits({"num_leaves": 64, "max_depth": -1}) == (0, 64)
    assert models._limits({"num_leaves": 255, "max_depth": 5}) == (5, 255)
    assert models._limits({}) == (6, 0)


BOARD = "name string, auprc double, auroc double, precision double, recall double, f1 double, threshold double"


def test_selection_rules(spark):
    rows = [
        ("a", 0.9, 0.9, 0.9, 0.5, 0.6, 0.5),
        ("b", 0.8, 0.9, 0.9, 0.7, 0.6, 0.5),
        ("c", 0.8, 0.9, 0.9, 0.7, 0.7, 0.5),
        ("d", float("nan"), 0.9, 0.9, 0.99, 0.9, 0.5),
        ("e", None, 0.9, 0.9, None, 0.9, 0.5),
    ]
    board = spark.createDataFrame(rows, BOARD)
    best = registry.select_model(board, "auprc", 0.6).first()
    assert (best["name"], best["filtered_count"], best["total_count"]) == ("c", 3, 5)
    fallback = registry.select_model(board, "pr_auc", 0.999).first()
    assert fallback["name"] == "a" and not fallback["used_recall_filter"]
    order = [r["name"] for r in models.ranked(board, "auprc").collect()]
    assert order == ["a", "b", "c", "d", "e"]


def test_versions_are_numbers(spark):
    rows = [("m", v, f"r{v}", t) for v, t in (("2", "0.2"), ("9", None), ("10", "bad"))]
    versions = spark.createDataFrame(rows, "model string, version string, run_id string, decision_threshold string")
    runs = spark.createDataFrame([("r10", 0.35)], "run_id string, threshold double")
    got = registry.serving_threshold(versions, runs).first()
    assert (got["version"], got["threshold"]) == ("10", 0.35)
    nothing = runs.filter("false")
    assert registry.serving_threshold(versions, nothing).first()["threshold"] == 0.5


def test_nearest_run_ignores_missing_metrics(spark):
    now = dt.datetime(2024, 1, 1)
    cols = ", ".join(f"test_{m} double" for m in registry.METRICS)
    runs = spark.createDataFrame(
        [
            ("r1", "final_a", "e1", now, 0.5, None, 0.5, 0.5, 0.5),
            ("r2", "final_a", "e2", now + dt.timedelta(1), 0.5, None, 0.5, 0.5, 0.5),
            ("r3", "final_b", "e1", now, 0.9, 0.9, 0.9, 0.9, 0.9),
        ],
        f"run_id string, run_name string, experiment string, start_time timestamp, {cols}",
    )
    chosen = spark.createDataFrame([("a", 0.5, 0.9, 0.5, 0.5, 0.5, 0.5)], BOARD)
    assert registry.closest_run(runs, chosen).first()["run_id"] == "r2"
    assert registry.newest_run(runs, "final_a", "e1").first()["run_id"] == "r1"


def test_queries_search_the_whole_budget(spark, sf, data, monkeypatch):
    from catalog import models as queries

    seen = {}

    def search(train, val, plan, chosen, **_):
        seen["candidates"] = chosen
        return spark.createDataFrame([("a", 1)], "name string, rank int")

    def tuned(_, names, space, trials, **options):
        seen["tuned"] = names, {(r["model"], r["param"], r["low"], r["high"]) for r in space.collect()}, trials, options
        return spark.createDataFrame([("a", 0, {}, 0.5, None)], "model string, trial int, params map<string,string>, value double, fit_error string")

    monkeypatch.setattr(queries.models, "search", search)
    queries.QUERIES["m01_search_multiclass"](spark, sf)
    assert [(c.name, c.merged()) for c in seen["candidates"]] == list(models.PRESETS.items())
    # No rows are fitted here: only what the query asks for counts.
    monkeypatch.setattr(queries, "_splits", lambda *_: {"train": data[0].withColumn(models.ID, F.col("y")), "val": data[1]})
    monkeypatch.setattr(queries, "_plan", lambda _: PLAN)
    monkeypatch.setattr(queries.models, "prepare", lambda *_: None)
    monkeypatch.setattr(queries.tune, "tune", tuned)
    queries.QUERIES["h02_tuned_best"](spark, sf)
    names, space, trials, options = seen["tuned"]
    whole = {(r["model"], r["param"], r["low"], r["high"]) for r in tune.space_table(spark, tune.DEFAULT_SPACE).collect()}
    assert names == ["xgb", "lgbm", "logreg"] and space == whole and trials == 100
    assert not {"minutes", "patience"} & set(options)


@pytest.mark.parametrize("classes, kind", [(["a", "b", "é"], "string"), ([1, 2, 10], "bigint"), ([False, True], "boolean"), ([0.5, 2.0], "double")])
def test_label_map_is_stored(spark, classes, kind):
    reg = registry.Registry(spark, new_path(spark, "registry"))
    assert reg.labels("r") == []
    reg.log_labels("r", classes, kind)
    reg.log_labels("other", classes[:1], kind)
    assert reg.labels("r") == classes and reg.labels("other") == classes[:1]
    with pytest.raises(ValueError):
        reg.log_labels("r", classes, kind)
    scored = spark.createDataFrame([(0, 1), (1, 0), (2, 99), (3, None)], "id int, prediction int")
    named = {r["id"]: r["label"] for r in labels.class_label(scored, reg.labels("r"), kind).collect()}
    assert named == {0: classes[1], 1: classes[0], 2: None, 3: None}


def test_folds_advance_side_by_side(spark, monkeypatch):
    together = threading.Barrier(3)

    def found(train, val, plan, chosen, **_):
        together.wait(60)  # ends only when every fold is here
        return train.sparkSession.createDataFrame([("logreg", None, 0.5)], "name string, fit_error string, auprc double")

    monkeypatch.setattr(models, "search", found)
    rows = spark.range(30).selectExpr("id", "cast(id % 2 as int) as y", "cast(id as double) as x")
    board = models.cross_validate(rows, FeaturePlan("y", ["x"]), models.candidates(), ("id",), folds=3)
    assert sorted(r["fold"] for r in board.collect()) == [0, 1, 2]


def test_tasks_are_small_unless_the_session_says(spark):
    own = spark.newSession()
    small_tasks(own)
    assert own.conf.get(ADVISORY) == "8m"
    own.conf.set(ADVISORY, "32m")
    small_tasks(own)
    assert own.conf.get(ADVISORY) == "32m"


def test_splits_leave_no_copy_of_the_feature_rows(spark, sf):
    """Once the splits are written, the rows that they were dealt from are removed; the fits need none but the splits."""
    from catalog import models as queries

    folder = spark._jvm.org.apache.hadoop.fs.Path(work_dir(spark))
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())

    def tables():
        return {f.getPath().getName() for f in files.listStatus(folder)}

    before = tables()
    found = queries._splits(spark, sf)
    kinds = {t.split("-")[0] for t in tables() - before}
    assert "splits" in kinds and "features" not in kinds
    assert all(found[s].count() > 0 for s in ("train", "val", "test"))
