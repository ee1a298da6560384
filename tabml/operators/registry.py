"""Model choice and bookkeeping: selection, run log, model versions, serving threshold.

Runs, versions and label maps are append-only tables; everything else is a query on them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabml.functions.scalars import finite
from tabml.operators.metrics import metric_name
from tabml.session import bounded_rows

METRICS = ("auprc", "auroc", "precision", "recall", "f1")
RUN_SCHEMA = (
    "run_id string, run_name string, experiment string, start_time timestamp, "
    + ", ".join(f"test_{m} double" for m in METRICS)
    + ", threshold double, model_path string"
)
VERSION_SCHEMA = (
    "model string, version string, run_id string, alias string, decision_threshold string, "
    "primary_metric string, min_recall double, "
    + ", ".join(f"test_{m} double" for m in METRICS)
)

LABEL_SCHEMA = "run_id string, class_id int, label string, kind string"


def select_model(leaderboard: DataFrame, primary: str = "auprc", min_recall: float = 0.6) -> DataFrame:
    """One row: the best model among those with enough recall, or among all if none has.

    Ordered by the primary metric, then F1; missing values last. The row tells how the
    choice was made.
    """
    metric = metric_name(primary)
    enough = F.coalesce(finite(F.col("recall")) >= min_recall, F.lit(False))
    low = F.lit(-1e9)
    best = leaderboard.agg(
        F.max_by(
            F.struct(*leaderboard.columns),
            F.struct(
                enough.alias("ok"),
                F.coalesce(finite(F.col(metric)), low).alias("m"),
                F.coalesce(finite(F.col("f1")), low).alias("f"),
                F.col("name").alias("n"),
            ),
        ).alias("best"),
        F.count_if(enough).alias("filtered_count"),
        F.count(F.lit(1)).alias("total_count"),
    )
    return best.select(
        "best.*",
        F.lit(metric).alias("primary_metric"),
        F.lit(float(min_recall)).alias("min_recall"),
        "filtered_count",
        "total_count",
        (F.col("filtered_count") > 0).alias("used_recall_filter"),
    )


def closest_run(runs: DataFrame, selected: DataFrame) -> DataFrame:
    """The run of the selected model whose test metrics are nearest; newest on a tie.

    Metrics missing on either side do not count.
    """
    chosen = selected.select(
        F.struct(F.concat(F.lit("final_"), "name").alias("run_name"), *METRICS).alias("c")
    ).scalar()
    rows = runs.withColumn("c", chosen).filter(F.col("run_name") == F.col("c.run_name"))
    gap = F.lit(0.0)
    for m in METRICS:
        d = F.col(f"c.{m}") - F.col(f"test_{m}")
        gap = gap + F.coalesce(d * d, F.lit(0.0))
    return (
        rows.withColumn("distance", gap)
        .drop("c")
        .orderBy("distance", F.col("start_time").desc(), "run_id")
        .limit(1)
    )


def newest_run(runs: DataFrame, name: str, experiment: str | None = None) -> DataFrame:
    """The newest run of that name, in one experiment or in all."""
    rows = runs.filter(F.col("run_name") == name)
    if experiment is not None:
        rows = rows.filter(F.col("experiment") == experiment)
    return rows.orderBy(F.col("start_time").desc(), "run_id").limit(1)


def latest_versions(versions: DataFrame) -> DataFrame:
    """The highest version of each model, by number and not by text."""
    number = F.col("version").cast("int")
    return versions.groupBy("model").agg(
        F.max_by(F.struct(*[c for c in versions.columns if c != "model"]), number).alias("v")
    ).select("model", "v.*")


def serving_threshold(versions: DataFrame, runs: DataFrame, default: float = 0.5) -> DataFrame:
    """(model, version, run_id, threshold): the version's own, else its run's, else 0.5."""
    stored = runs.select("run_id", F.col("threshold").alias("run_threshold"))
    return latest_versions(versions).join(stored, "run_id", "left").select(
        "model",
        "version",
        "run_id",
        F.coalesce(
            F.col("decision_threshold").try_cast("double"), "run_threshold", F.lit(default)
        ).alias("threshold"),
    )


def next_version(versions: DataFrame, model: str) -> int:
    top = versions.filter(F.col("model") == model).agg(F.max(F.col("version").cast("int"))).first()[0]
    return (top or 0) + 1


def version_row(selected: DataFrame, run: DataFrame, model: str, version: int) -> DataFrame:
    """The new version of the model: the choice, its run, its threshold and test metrics."""
    run_id = run.select("run_id").scalar()
    return selected.select(
        F.lit(model).alias("model"),
        F.lit(str(version)).alias("version"),
        run_id.alias("run_id"),
        F.col("name").alias("alias"),
        F.format_string("%.6f", F.coalesce(F.col("threshold"), F.lit(0.5))).alias("decision_threshold"),
        "primary_metric",
        "min_recall",
        *[finite(F.col(m)).alias(f"test_{m}") for m in METRICS],
    )


@dataclass(frozen=True)
class Registry:
    """The three tables at a path in shared storage. One writer at a time."""

    spark: SparkSession
    path: str

    def _read(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def runs(self) -> DataFrame:
        return self._read("runs", RUN_SCHEMA)

    def versions(self) -> DataFrame:
        return self._read("model_versions", VERSION_SCHEMA)

    def log_runs(self, rows: DataFrame) -> None:
        rows.write.mode("append").parquet(f"{self.path}/runs")

    def log_leaderboard(self, board: DataFrame, experiment: str, paths: dict[str, str], run_prefix: str) -> None:
        """One run per model of the final leaderboard."""
        path = F.lit(None).cast("string")
        for name, p in paths.items():
            path = F.when(F.col("name") == name, F.lit(p)).otherwise(path)
        self.log_runs(
            board.select(
                F.concat(F.lit(run_prefix), F.lit("-"), "name").alias("run_id"),
                F.concat(F.lit("final_"), "name").alias("run_name"),
                F.lit(experiment).alias("experiment"),
                F.current_timestamp().alias("start_time"),
                *[F.col(m).alias(f"test_{m}") for m in METRICS],
                "threshold",
                path.alias("model_path"),
            )
        )

    def register(self, selected: DataFrame, model: str) -> int:
        """Append the selected model as the next version and return its number."""
        version = next_version(self.versions(), model)
        run = closest_run(self.runs(), selected)
        version_row(selected, run, model, version).write.mode("append").parquet(
            f"{self.path}/model_versions"
        )
        return version

    def log_labels(self, run_id: str, classes: list, kind: str) -> None:
        """Store the label map of a run: the place of a class is its id, ``kind`` the type of the label.

        A run has one map; a second one is an error.
        """
        if self.labels(run_id):
            raise ValueError(f"run {run_id!r} has a label map")
        rows = [(run_id, i, str(v), kind) for i, v in enumerate(classes)]
        self.spark.createDataFrame(rows, LABEL_SCHEMA).write.mode("append").parquet(f"{self.path}/label_maps")

    def labels(self, run_id: str) -> list:
        """The classes of a run by id, in the type they had; empty where none were stored."""
        rows = self._read("label_maps", LABEL_SCHEMA).filter(F.col("run_id") == run_id)
        kind = rows.agg(F.max("kind")).first()[0]
        if kind is None:
            return []
        found = rows.select("class_id", F.col("label").cast(kind).alias("label"))
        return [r["label"] for r in sorted(bounded_rows(found, 100_000, "classes of the run"), key=lambda r: r["class_id"])]

    def serving(self, model: str, default: float = 0.5) -> dict:
        """Version, model path, threshold and label map to score with."""
        found = (
            serving_threshold(self.versions(), self.runs(), default)
            .filter(F.col("model") == model)
            .join(self.runs().select("run_id", "model_path"), "run_id", "left")
            .first()
        )
        if found is None:
            raise LookupError(f"no version of {model!r}")
        return found.asDict() | {"labels": self.labels(found["run_id"])}
