"""Planning rules as table work over the data card."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Policies:
    high_cardinality_ratio: float = 0.5
    # Used by the rule that looks at the number of levels.
    max_levels: int = 50
    imbalance_ratio: float = 3.0
    min_recall: float = 0.6
    time_split_days: int = 180
    allow_text: bool = False
    # With a number, the family meant for small tables is left out beyond so many rows.
    small_rows: int | None = None

    @staticmethod
    def merged(values: dict | None) -> "Policies":
        """File values over the defaults; ``thresholds`` may be nested."""
        flat = dict(values or {})
        nested = flat.pop("thresholds", {}) or {}
        names = {
            "high_cardinality_unique_ratio": "high_cardinality_ratio",
            "time_aware_split_min_days": "time_split_days",
        }
        flat = {names.get(k, k): v for k, v in {**flat, **nested}.items()}
        known = Policies.__dataclass_fields__
        return Policies(**{k: v for k, v in flat.items() if k in known})


def min_recall(plan: float | None = None, argument: float | None = None, config: float | None = None) -> float:
    """Plan before argument before configuration before 0.6."""
    for value in (plan, argument, config):
        if value is not None:
            return float(value)
    return 0.6


def primary_metric(plan: str | None = None, argument: str | None = None, config: str | None = None) -> str:
    """Argument before plan before configuration before average precision."""
    return argument or plan or config or "auprc"


def column_plan(card: DataFrame, policies: Policies = Policies(), encoder_rule: str = "ratio") -> DataFrame:
    """Bucket, drop flag, imputer and encoder per column.

    ``encoder_rule`` picks the split of the categorical columns: by ``ratio`` of
    distinct values to rows, or by number of ``levels``.
    """
    kind = F.col("inferred_type")
    if encoder_rule == "levels":
        high = F.col("n_unique") > policies.max_levels
    else:
        high = F.col("unique_ratio") > policies.high_cardinality_ratio
    bucket = (
        F.when(F.col("role") == "target", "target")
        .when(kind == "categorical", F.when(high, "categorical_high").otherwise("categorical_low"))
        .when(kind == "id", "ids")
        .otherwise(kind)
    )
    leaks = F.col("leaks") if "leaks" in card.columns else F.lit(False)
    text = "tfidf" if policies.allow_text else "ignore"
    return card.select(
        "column",
        bucket.alias("bucket"),
        (F.col("suspected_id") | leaks).alias("dropped"),
        F.when(bucket == "numeric", "median")
        .when(bucket.isin("categorical_low", "categorical_high", "boolean"), "most_frequent")
        .alias("imputer"),
        F.when(bucket.isin("categorical_low", "boolean"), "onehot")
        .when(bucket == "categorical_high", "target_mean")
        .when(bucket == "numeric", "standardise")
        .when(bucket == "text", text)
        .alias("encoder"),
    )


def class_weights(df: DataFrame, target: str, policies: Policies = Policies()) -> DataFrame:
    """Per class: balanced weight n / (k * n_class), and the weight of the positive class.

    ``pos_weight`` is max(1, negatives / positives); the positive class is 1, "1" or
    true if present, else the rarest one.
    """
    counts = (
        df.filter(F.col(target).isNotNull())
        .groupBy(F.col(target).cast("string").alias("class"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    likely = F.when(F.col("class") == "1", 0).when(F.lower("class") == "true", 1).otherwise(2)
    facts = counts.agg(
        F.struct(
            F.sum("n").alias("total"),
            F.count(F.lit(1)).alias("k"),
            (F.max("n") / F.greatest(F.min("n"), F.lit(1))).alias("ratio"),
            F.min(F.struct(likely.alias("a"), F.col("n").alias("b"), F.col("class").alias("c"))).alias("p"),
        ).alias("f")
    ).scalar()
    rows = counts.withColumn("f", facts)
    positives = F.col("f.p.b")
    return rows.select(
        "class",
        "n",
        F.round(F.col("f.total") / (F.col("f.k") * F.col("n")), 6).alias("balanced_weight"),
        (F.col("class") == F.col("f.p.c")).alias("positive"),
        F.round(
            F.greatest(F.lit(1.0), (F.col("f.total") - positives) / F.greatest(positives, F.lit(1))), 4
        ).alias("pos_weight"),
        ((F.col("f.k") >= 2) & (F.col("f.ratio") >= policies.imbalance_ratio)).alias("imbalanced"),
    )


def time_split_rule(coverage: DataFrame, timestamp: str | None, policies: Policies = Policies()) -> DataFrame:
    """Whether the named (else the first) datetime column spans enough days."""
    chosen = coverage.filter(F.col("column") == timestamp) if timestamp else coverage.limit(1)
    return chosen.select(
        "column",
        "coverage_days",
        F.coalesce(F.col("coverage_days") >= policies.time_split_days, F.lit(False)).alias("time_aware"),
    )


# ---------------------------------------------------------------- models

# Plan names of the models and the names the search uses.
MODEL_NAMES = {
    "logreg": "logreg",
    "linear": "logreg",
    "elasticnet": "logreg",
    "xgboost": "xgb",
    "lightgbm": "lgbm",
    "catboost": "cat",
}

# The plan's search ranges (model, parameter, kind, low, high), of the
# parameters that our estimators take. The leaf size of the second model depends on the
# number of rows and is added below.
SPACE = [
    ("lightgbm", "num_leaves", "int", 15.0, 255.0),
    ("lightgbm", "max_depth", "int", -1.0, 12.0),
    ("lightgbm", "feature_fraction", "float", 0.6, 1.0),
    ("lightgbm", "bagging_fraction", "float", 0.6, 1.0),
    ("xgboost", "max_depth", "int", 3.0, 12.0),
    ("xgboost", "min_child_weight", "int", 1.0, 20.0),
    ("xgboost", "subsample", "float", 0.5, 1.0),
    ("xgboost", "colsample_bytree", "float", 0.5, 1.0),
    ("xgboost", "eta", "loguniform", 0.001, 0.2),
    ("xgboost", "gamma", "float", 0.0, 10.0),
    ("xgboost", "n_estimators", "int", 200.0, 1200.0),
    ("catboost", "depth", "int", 4.0, 10.0),
    ("catboost", "learning_rate", "loguniform", 0.001, 0.2),
    ("catboost", "iterations", "int", 300.0, 1500.0),
    ("logreg", "C", "loguniform", 0.001, 10.0),
    ("elasticnet", "alpha", "loguniform", 0.0001, 10.0),
    ("elasticnet", "l1_ratio", "float", 0.0, 1.0),
]
CLASSIFIERS = ("lightgbm", "xgboost", "catboost", "logreg")
REGRESSORS = ("lightgbm", "xgboost", "elasticnet")
LEAF_SHARE = (0.001, 0.05)
LEAF_FLOOR = (10, 20)


def search_space(df: DataFrame, task: str = "binary", policies: Policies = Policies()) -> DataFrame:
    """(model, param, kind, low, high, only_if) for the plan's models.

    The leaf size is 0.1 % to 5 % of the rows; one family is meant for small tables, see
    ``Policies.small_rows``.
    """
    spark: SparkSession = df.sparkSession
    models = REGRESSORS if task == "regression" else CLASSIFIERS
    fixed = spark.createDataFrame(
        [row for row in SPACE if row[0] in models],
        "model string, param string, kind string, low double, high double",
    )
    rows = df.agg(F.count(F.lit(1)).alias("n"))

    def leaf(i: int):
        size = F.floor(F.col("n") * F.lit(LEAF_SHARE[i])).cast("double")
        return F.greatest(F.lit(float(LEAF_FLOOR[i])), size)

    leaves = rows.select(
        F.lit("lightgbm").alias("model"),
        F.lit("min_data_in_leaf").alias("param"),
        F.lit("int").alias("kind"),
        leaf(0).alias("low"),
        leaf(1).alias("high"),
    )
    limit = policies.small_rows
    small = F.lit(True) if limit is None else rows.select(F.col("n") <= limit).scalar()
    return fixed.unionByName(leaves).withColumn(
        "only_if", F.when(F.col("model") == "catboost", small).otherwise(F.lit(True))
    )


def model_blocks(df: DataFrame, target: str, task: str = "binary", policies: Policies = Policies()) -> DataFrame:
    """One row per model of the plan: name, only_if, fit_params and ranges as JSON.

    The class weights of the training rows become fit parameters: a positive weight for one
    family, a balance flag for the others where the classes are uneven enough. Regression
    models have none.
    """
    space = search_space(df, task, policies).groupBy("model").agg(
        F.bool_and("only_if").alias("only_if"),
        F.to_json(
            F.array_sort(F.collect_list(F.struct("param", "kind", "low", "high")))
        ).alias("ranges"),  # a few parameters per model
    )
    if task == "regression":
        return space.select("model", "only_if", F.lit("{}").alias("fit_params"), "ranges")
    facts = class_weights(df, target, policies).agg(
        F.struct(F.max("pos_weight").alias("weight"), F.bool_or("imbalanced").alias("uneven")).alias("f")
    ).scalar()
    flagged = space.withColumn("f", facts)
    uneven = F.coalesce("f.uneven", F.lit(False))
    params = F.when(F.col("model") == "lightgbm", F.to_json(F.struct(uneven.alias("is_unbalance"))))
    if task == "binary":
        params = params.when(F.col("model") == "xgboost", F.to_json(F.struct(F.col("f.weight").alias("scale_pos_weight"))))
        balanced = F.when(uneven, F.lit("Balanced"))
        params = params.when(F.col("model") == "catboost", F.to_json(F.struct(balanced.alias("auto_class_weights"))))
    return flagged.select("model", "only_if", F.coalesce(params, F.lit("{}")).alias("fit_params"), "ranges")


def evaluation_settings(
    task: str, metric: str | None = None, floor: float | None = None, secondary: list[str] = ()
) -> dict:
    """What a run is judged by; the metric's default follows the task."""
    return {
        "primary_metric": metric or ("rmse" if task == "regression" else "auprc"),
        "secondary_metrics": list(secondary),
        "tune_threshold": task == "binary",
        "min_recall": min_recall(floor),
    }
