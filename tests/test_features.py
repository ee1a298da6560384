import datetime
import math

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tabml.operators import extras, features, labels, profile
from tabml.operators.features import FeaturePlan, Preprocessor, modes, months_as_text
from tabml.plans import rules
from tabml.session import new_path

SCHEMA = "id int, x double, c string, h string, y int"
TRAIN = [
    (1, 1.0, "a", "p", 1), (2, None, "a", "p", 0), (3, 3.0, "b", "q", 1), (4, 8.0, "b", None, 0),
    (5, float("nan"), None, "r", 1),
]
NEW = [(10, None, "z", "new", None), (11, 4.0, "b", "q", 1), (12, 1.0, None, None, 0)]


@pytest.fixture(scope="module")
def model(spark):
    plan = FeaturePlan("y", ["x"], ["c"], ["h"], scale=True, positive="1")
    return Preprocessor.of(plan).fit(spark.createDataFrame(TRAIN, SCHEMA))


def test_values_come_from_training_rows(spark, model):
    got = {r["id"]: r for r in model.named(spark.createDataFrame(NEW, SCHEMA), "id").collect()}
    # median of 1, 3, 8 is 3; filled: 1, 3, 3, 8, 3; mean 3.6, population deviation 2.3323...
    mean, std = 3.6, (((2.6**2) + 3 * (0.6**2) + (4.4**2)) / 5) ** 0.5
    assert got[10]["x"] == pytest.approx((3 - mean) / std)
    assert got[11]["x"] == pytest.approx((4 - mean) / std)
    # unseen level: all zeros; missing: the most frequent level, smallest on a tie
    assert (got[10]["c=a"], got[10]["c=b"]) == (0.0, 0.0)
    assert (got[12]["c=a"], got[12]["c=b"]) == (1.0, 0.0)
    # h: p is the mode, so the missing one joins it: p -> (1, 0, 0), q -> 1, r -> 1; all 3/5
    assert got[10]["h_tmean"] == pytest.approx(0.6)
    assert got[11]["h_tmean"] == 1.0
    assert got[12]["h_tmean"] == pytest.approx(1 / 3)


def test_lookup_without_broadcast_gives_the_same(spark, model, monkeypatch):
    """The path for tables too large to broadcast, with one value on most rows."""
    from tabml.functions import lookup

    many = [(i, 1.0, "a", "p" if i % 3 else None, 0) for i in range(300)] + [(i, None, "b", "q", 1) for i in range(300, 330)]
    new = spark.createDataFrame(many, SCHEMA)
    want = sorted(map(tuple, model.named(new, "id").collect()))
    monkeypatch.setattr(lookup, "SMALL_ROWS", -1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = model.named(new, "id")
        assert sorted(map(tuple, plan.collect())) == want
        assert "BroadcastHashJoin" not in plan._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_saved_and_loaded(spark, model):
    path = new_path(spark, "pipeline")
    PipelineModel(stages=[model]).write().save(path)
    again = PipelineModel.load(path)
    new = spark.createDataFrame(NEW, SCHEMA)
    a = sorted((r["id"], tuple(r["features"])) for r in model.transform(new).collect())
    b = sorted((r["id"], tuple(r["features"])) for r in again.transform(new).collect())
    assert a == b


def test_mode_ties_go_to_the_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), (None,), (None,)], "c string")
    assert modes(df, ["c"]).first()["mode"] == "a"


def test_mean_target_for_fractional_labels(spark):
    rows = [("a", 1.5), ("a", 2.5), ("b", 3.0), ("b", 4.0), ("c", 5.0), ("c", 7.5)]
    df = spark.createDataFrame(rows, "h string, y double")
    model = Preprocessor.of(FeaturePlan("y", target_mean=["h"])).fit(df)
    got = {r["h"]: r["h_tmean"] for r in model.named(df, "h").collect()}
    assert got == {"a": 2.0, "b": 3.5, "c": 6.25}


def test_default_plan(spark):
    df = spark.sql("select 1 as id, 2.0D as x, 'u' as c, date'2024-05-06' as d, 1 as y")
    plan = FeaturePlan.default(df, "y", drop=["id"])
    assert (plan.numeric, plan.onehot, plan.scale) == (["x"], ["c", "d"], False)
    assert months_as_text(df).first()["d"] == "2024-05"


def test_labels(spark):
    df = spark.createDataFrame([(" TRUE", "1.0", 2), ("false", None, 1), (None, "0", 2)], "a string, b string, c int")
    got = df
    for c in "abc":
        got = labels.encode_binary(got, c, out=f"{c}_y")
    got = labels.encode_binary(got, "c", positive="2.0", out="two").collect()
    assert [r["a_y"] for r in got] == [1, 0, None]
    assert [r["b_y"] for r in got] == [1, 0, 0]
    assert [r["c_y"] for r in got] == [2, 1, 2]
    assert [r["two"] for r in got] == [1, 0, 1]
    classes = labels.label_map(df, "a")
    ids = labels.index_label(df, "a", classes).orderBy("c", "b").collect()
    assert classes == [" TRUE", "false"] and {r["a"]: r["class_id"] for r in ids} == {" TRUE": 0, "false": 1, None: None}
    assert labels.with_label(df, "b").count() == 2
    assert labels.with_label(df, "b", "1").filter("b = '1'").count() == 1


def test_type_inference(spark):
    df = spark.createDataFrame(
        [(1, 0.0, "no", "a" * 30, None, 5.0, "x"), (2, 1.0, "yes", "b" * 30, None, 6.0, "y"), (3, 1.0, "no", "c" * 30, None, 7.0, "z")],
        "rx_paid_total int, flag double, word string, note string, none string, amount double, cat string",
    )
    got = {r["column"]: r for r in profile.column_profile(df).collect()}
    kinds = {c: r["inferred_type"] for c, r in got.items()}
    # "rx_paid_" matches the identifier pattern inside a word; two words count as boolean
    assert kinds == {
        "rx_paid_total": "id", "flag": "boolean", "word": "boolean", "note": "text", "none": "boolean",
        "amount": "numeric", "cat": "categorical",
    }
    assert got["cat"]["suspected_id"] and not got["word"]["suspected_id"]
    assert got["none"]["constant"]


def test_coverage_counts_elapsed_days(spark):
    df = spark.sql("select timestamp'2024-01-01 23:00:00' as t union all select timestamp'2024-01-03 01:00:00'")
    assert profile.time_coverage(df).first()["coverage_days"] == 1


def test_data_card_and_plan(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet").withColumn("y", (F.col("o_orderstatus") == "F").cast("int"))
    orders = orders.withColumn("copy", F.col("y"))
    opts = profile.ProfileOptions(target="y", id_column="o_orderkey")
    card = profile.data_card(orders, opts).cache()
    plan = {r["column"]: r for r in rules.column_plan(card).collect()}
    assert plan["o_orderkey"]["dropped"] and plan["copy"]["dropped"]
    assert plan["o_totalprice"]["encoder"] == "standardise" and plan["y"]["bucket"] == "target"
    top = {r["column"]: r["topk"] for r in card.collect()}["o_orderpriority"]
    assert [t["place"] for t in top] == list(range(1, len(top) + 1))


def test_policies_file_values():
    p = rules.Policies.merged({"thresholds": {"high_cardinality_unique_ratio": 0.4}, "min_recall": 0.7, "other": 1})
    assert (p.high_cardinality_ratio, p.min_recall, p.time_split_days) == (0.4, 0.7, 180)
    assert rules.min_recall(None, 0.5, 0.4) == 0.5 and rules.min_recall() == 0.6


def test_encoder_follows_the_ratio_alone(spark):
    df = spark.range(3000).select(
        (F.col("id") % 1200).cast("string").alias("c"), (F.col("id") % 1600).cast("string").alias("d"), (F.col("id") % 2).alias("y")
    )
    card = profile.column_profile(df, profile.ProfileOptions(target="y"))
    plan = {r["column"]: r["encoder"] for r in rules.column_plan(card).collect()}
    assert (plan["c"], plan["d"]) == ("onehot", "target_mean")


def test_twenty_thousand_levels(spark):
    df = spark.range(40_000).select(
        "id", (F.col("id") % 20_000).cast("string").alias("c"), F.lit("x").alias("d"), F.lit(2.0).alias("n"), (F.col("id") % 2).alias("y")
    )
    model = Preprocessor.of(FeaturePlan("y", ["n"], ["c", "d"], scale=False)).fit(df.filter("id % 20000 > 0"))
    assert len(model.slots()) == 1 + 19_999 + 1
    new = spark.createDataFrame([(1, "7"), (2, "0"), (3, None)], "id int, c string").select("*", F.lit("x").alias("d"), F.lit(2.0).alias("n"))
    rows = {r["id"]: r["features"] for r in model.transform(new).select("id", "features").collect()}
    at = model.slots().index("c=7")
    assert all(v.size == 20_001 for v in rows.values())
    assert dict(zip(rows[1].indices, rows[1].values)) == {0: 2.0, at: 1.0, 20_000: 1.0}
    assert rows[2].numNonzeros() == 2  # not seen: no slot
    assert rows[3].numNonzeros() == 3  # missing: the mode
    entries = {(r["id"], r["slot"], r["value"]) for r in model.entries(new, "id").collect()}
    assert {e for e in entries if e[0] < 3} == {(1, "n", 2.0), (1, "c=7", 1.0), (1, "d=x", 1.0), (2, "n", 2.0), (2, "d=x", 1.0)}
    assert set(model.transform(new).columns) == {"id", "c", "d", "n", "features"}


def test_positive_class_is_found_or_refused(spark):
    rows = [("a", "yes"), ("a", "no"), ("b", "no"), ("b", "no"), ("a", None)]
    df = spark.createDataFrame(rows, "c string, y string")
    model = Preprocessor.of(FeaturePlan("y", target_mean=["c"])).fit(df)
    assert {r["c"]: r["c_tmean"] for r in model.named(df, "c").collect()} == {"a": 0.5, "b": 0.0}
    assert features.positive_class(df, "y", "no") == "no"
    with pytest.raises(ValueError):
        Preprocessor.of(FeaturePlan("y", target_mean=["c"], positive="1")).fit(df)


def test_unused_columns_are_listed(spark):
    rows = [("y", "target", None, False), ("t", "text", "tfidf", False), ("u", "text", "ignore", False), ("n", "numeric", "standardise", False), ("i", "ids", None, True)]
    plan = FeaturePlan.from_columns(spark.createDataFrame(rows, "column string, bucket string, encoder string, dropped boolean"), "y")
    assert (plan.numeric, plan.dropped) == (["n"], ["i", "t", "u"])


def test_text_weights(spark):
    df = spark.createDataFrame([(1, "A a b"), (2, "b  c"), (3, ""), (4, None)], "id int, t string")
    got = {(r["id"], r["term"]): (r["tf"], r["docs"], r["weight"]) for r in extras.text_weights(df, "id", "t").collect()}
    assert {k: v[:2] for k, v in got.items()} == {(1, "a"): (2, 1), (1, "b"): (1, 2), (2, "b"): (1, 2), (2, "c"): (1, 1)}
    assert got[1, "a"][2] == pytest.approx(2 * math.log(5 / 2)) and got[2, "b"][2] == pytest.approx(math.log(5 / 3))


def test_pairs_use_the_rows_where_both_are_known(spark):
    rows = [(float(i), None if i % 10 else 2.0 * i, float((i * 7) % 11)) for i in range(200)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    assert extras.correlated_columns(df, ["a", "b", "c"]) == ["b"]


def test_association_with_many_classes_and_with_numbers(spark):
    df = spark.range(6000).select(
        F.col("id").alias("x"), (F.col("id") % 7).alias("noise"), (F.col("id") % 3000).cast("string").alias("many"), F.col("id").cast("double").alias("y")
    )
    by_class = {r["column"]: r["mutual_information"] for r in profile.mutual_information(df, ["x", "noise"], [], "many").collect()}
    assert by_class["x"] > 0.5 and by_class["x"] > by_class["noise"] > 0
    by_rank = {r["column"]: r["mutual_information"] for r in profile.mutual_information(df, ["x", "noise"], [], "y", task="regression").collect()}
    assert by_rank["x"] == pytest.approx(math.log(20)) and by_rank["noise"] < 0.01
    summary = profile.target_summary(df, "y", "regression").collect()
    assert [(r["class"], r["n"], r["task"]) for r in summary] == [(None, 6000, "regression")]


def test_correlated_wide(spark):
    cols = [F.rand(i).alias(f"c{i}") for i in range(41)]
    df = spark.range(500).select(*cols).withColumn("twin", F.col("c3") * 2)
    assert extras.correlated_columns(df, df.columns) == ["twin"]


def test_month_cycle_turns_once_a_year(spark):
    df = spark.sql("select * from values (1, date '2020-03-05'), (2, date '2020-12-31'), (3, null) as t(k, at)")
    got = {r["k"]: (r["at_month_sin"], r["at_month_cos"]) for r in extras.month_cycle(df, "at").collect()}
    assert got[1] == pytest.approx((1.0, 0.0), abs=1e-12) and got[2] == pytest.approx((0.0, 1.0), abs=1e-12)
    assert got[3] == (None, None)


def test_text_weights_with_kept_columns(spark):
    """Kept columns come along; a repeated key counts once, and a key that is NULL counts but has no rows."""
    rows = [(1, "a b a", "x"), (2, "b", "y"), (2, "B c", "z"), (None, "c", "x"), (3, None, "x")]
    df = spark.createDataFrame(rows, "id int, t string, l string")
    got = sorted((r["id"], r["l"], r["term"], r["tf"], r["docs"]) for r in extras.text_weights(df, "id", "t", ("l",)).collect())
    assert got == [(1, "x", "a", 2, 1), (1, "x", "b", 1, 2), (2, "y", "b", 2, 2), (2, "y", "c", 1, 2), (2, "z", "b", 2, 2), (2, "z", "c", 1, 2)]


def test_card_reads_its_profile_once_and_tells_values_apart(spark):
    """Zeros of both signs, texts around the length that is kept whole, days; the card reads the written profile."""
    long = "x" * 60
    rows = [(0.0, "1", datetime.date(1970, 1, 1), True, long), (-0.0, "1.0", datetime.date(1970, 1, 2), False, long + "y"), (0.0, "0", None, None, None)]
    df = spark.createDataFrame(rows, "f double, s string, d date, b boolean, t string").withColumn("y", F.lit(1))
    got = {r["column"]: (r["n_unique"], r["zero_one"]) for r in profile.distinct_counts(df, df.columns).collect()}
    assert got == {"f": (2, True), "s": (3, True), "d": (2, True), "b": (2, True), "t": (2, True), "y": (1, True)}
    card = profile.data_card(df, profile.ProfileOptions(target="y"))
    assert "zero_one" not in card._jdf.queryExecution().optimizedPlan().toString()
    assert {r["column"]: r["n_unique"] for r in card.collect()} == {c: n for c, (n, _) in got.items()}
