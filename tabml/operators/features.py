"""Preprocessing: impute, scale, one-hot and target-mean encode, fitted on training rows only.

``Preprocessor`` and ``PreprocessorModel`` are pipeline stages. What is learned per
column (medians, means, modes) is a few values per column and lives in the model; target
means and one-hot levels may have one row per distinct value, so they stay tables and are
joined.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabml.functions.lookup import lookup
from tabml.functions.ordered import exact_quantiles, numbered
from tabml.functions.scalars import month_text
from tabml.operators.profile import kinds, target_summary, value_counts, without_nan
from tabml.session import bounded_rows, staged

MOST_NAMES = 100_000  # slots that ``named`` makes columns of


@dataclass(frozen=True)
class FeaturePlan:
    """Which columns are used, and how."""

    target: str
    numeric: list[str] = field(default_factory=list)
    onehot: list[str] = field(default_factory=list)
    target_mean: list[str] = field(default_factory=list)
    dropped: list[str] = field(default_factory=list)
    scale: bool = True
    positive: str | None = None  # of a target with classes; None: found in the training rows

    @staticmethod
    def from_columns(plan: DataFrame, target: str, keep_out: list[str] = (), **options) -> "FeaturePlan":
        """From ``column_plan`` rows: one row per column of the table."""
        groups: dict[str, list[str]] = {"standardise": [], "onehot": [], "target_mean": []}
        dropped = []
        for row in plan.collect():
            name = row["column"]
            if name == target and name not in keep_out and not row["dropped"]:
                continue
            if row["dropped"] or name in keep_out or row["encoder"] not in groups:
                dropped.append(name)
            else:
                groups[row["encoder"]].append(name)
        return FeaturePlan(
            target=target,
            numeric=groups["standardise"],
            onehot=groups["onehot"],
            target_mean=groups["target_mean"],
            dropped=sorted(dropped),
            **options,
        )

    @staticmethod
    def default(df: DataFrame, target: str, drop: list[str] = (), **options) -> "FeaturePlan":
        """Without a plan: numbers pass through, everything else is one-hot encoded."""
        out = {target, *drop}
        types = {c: k for c, k in kinds(df).items() if c not in out}
        return FeaturePlan(
            target=target,
            numeric=[c for c, k in types.items() if k == "number"],
            onehot=[c for c, k in types.items() if k != "number"],
            dropped=sorted(drop),
            **{"scale": False, **options},
        )


def months_as_text(df: DataFrame) -> DataFrame:
    """Datetime columns as YYYY-MM text."""
    times = [c for c, k in kinds(df).items() if k == "time"]
    return df.withColumns({c: month_text(F.col(f"`{c}`")) for c in times}) if times else df


def select_columns(df: DataFrame, plan: FeaturePlan) -> DataFrame:
    """The planned columns and the target; names that do not exist are ignored."""
    used = [*plan.numeric, *plan.onehot, *plan.target_mean, plan.target]
    return df.select(*[F.col(f"`{c}`") for c in dict.fromkeys(used) if c in df.columns])


# ---------------------------------------------------------------- fitted values


def medians(train: DataFrame, columns: list[str]) -> DataFrame:
    return exact_quantiles(train, columns, {"median": 0.5})


def modes(train: DataFrame, columns: list[str]) -> DataFrame:
    """The most frequent value per column; ties go to the smallest."""
    counts = value_counts(train, columns).filter(F.col("value").isNotNull())
    return counts.groupBy("column").agg(
        F.min(F.struct((-F.col("n")).alias("n"), F.col("value").alias("value"))).alias("m")
    ).select("column", F.col("m.value").alias("mode"))


def moments(train: DataFrame, columns: list[str], fills: dict[str, float]) -> DataFrame:
    """Mean and population deviation per column after imputation, in one pass."""
    entries = [
        F.struct(F.lit(c).alias("column"), F.avg(x).alias("mean"), F.stddev_pop(x).alias("std"))
        for c in columns
        for x in [F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(fills.get(c)))]
    ]
    return train.agg(F.array(*entries).alias("all")).select(F.inline("all"))


def positive_class(train: DataFrame, target: str, wanted: str | None = None) -> str:
    """The class that counts as positive: the wanted one, which has to occur, else 1, "1" or
    true, else the rarest."""
    counts = target_summary(train, target).filter(F.col("class").isNotNull())
    if wanted is None:
        likely = F.when(F.col("class") == "1", 0).when(F.lower("class") == "true", 1).otherwise(2)
        found = counts.orderBy(likely, "n", "class").first()
    else:
        number = F.coalesce(F.col("class").try_cast("double") == F.lit(str(wanted)).try_cast("double"), F.lit(False))
        found = counts.filter((F.col("class") == str(wanted)) | number).first()
    if found is None:
        raise ValueError(f"no training row of class {wanted!r} in {target!r}")
    return found["class"]


def label_value(train: DataFrame, plan: FeaturePlan) -> Column:
    """What target means average: the label itself for a fractional target with more than
    five values, else whether it is the positive class."""
    y = F.col(plan.target)
    if train.schema[plan.target].dataType.simpleString() in ("double", "float"):
        distinct = train.select(plan.target).filter(y.isNotNull()).distinct().limit(6).count()
        if distinct > 5:
            return y.cast("double")
    positive = F.lit(positive_class(train, plan.target, plan.positive))
    same = F.coalesce(
        y.cast("string").try_cast("double") == positive.try_cast("double"),
        y.cast("string") == positive,
    )
    return F.when(y.isNotNull(), same.cast("double"))


def target_means(train: DataFrame, plan: FeaturePlan, fills: dict[str, str]) -> DataFrame:
    """(column, value, mean) after imputation; a row with NULL value is the global mean."""
    pairs = [
        F.struct(
            F.lit(c).alias("column"),
            F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(fills.get(c))).alias("value"),
        )
        for c in plan.target_mean
    ]
    rows = train.select(label_value(train, plan).alias("y"), F.explode(F.array(*pairs)).alias("p"))
    sums = (
        rows.filter(F.col("y").isNotNull() & F.col("p.value").isNotNull())
        .groupBy("p.column", "p.value")
        .agg(F.sum("y").alias("s"), F.count("y").alias("n"))
    )
    total = sums.groupBy("column").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    both = sums.unionByName(total.withColumn("value", F.lit(None).cast("string")))
    return both.select("column", "value", (F.col("s") / F.col("n")).alias("mean"))


def out_of_fold_means(rows: DataFrame, plan: FeaturePlan, fills: dict[str, str], fold: str = "fold") -> DataFrame:
    """(fold, column, value, mean): the label's mean over the rows of the *other* folds with that value.

    For encoding training rows without their own labels. A row with NULL value is the fold's mean
    over all values; a value that no other fold has gets no row, and takes that one. One count per
    (fold, column, value) is made; what the other folds hold is the total less the own count.
    """
    pairs = [
        F.struct(
            F.lit(c).alias("column"), F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(fills.get(c))).alias("value")
        )
        for c in plan.target_mean
    ]
    rows = rows.select(F.col(fold).alias("fold"), label_value(rows, plan).alias("y"), F.explode(F.array(*pairs)).alias("p"))
    own = (
        rows.filter(F.col("y").isNotNull() & F.col("p.value").isNotNull())
        .groupBy("fold", "p.column", "p.value")
        .agg(F.sum("y").alias("s"), F.count("y").alias("n"))
    )
    own = staged(own, "fold-counts")
    # One row a fold and column: few.
    folds = own.groupBy("fold", "column").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))

    def others(mine: DataFrame, by: list[str]) -> DataFrame:
        whole = mine.groupBy(*by).agg(F.sum("s").alias("all_s"), F.sum("n").alias("all_n"))
        every = whole.join(folds.select("fold", "column"), "column").join(mine, ["fold", *by], "left")
        n = F.col("all_n") - F.coalesce("n", F.lit(0))
        return every.withColumn("mean", (F.col("all_s") - F.coalesce("s", F.lit(0.0))) / n).filter(n > 0)

    by_value = others(own, ["column", "value"]).select("fold", "column", "value", "mean")
    overall = others(folds, ["column"]).select("fold", "column", F.lit(None).cast("string").alias("value"), "mean")
    return by_value.unionByName(overall)


def levels(train: DataFrame, columns: list[str], fills: dict[str, str]) -> DataFrame:
    """(column, value, index) of the one-hot levels: one slot of the feature vector each, in the values' order.

    The dictionary is a written table, numbered range by range; the driver sees a count per column.
    """
    counts = value_counts(train, columns).select(
        "column", F.coalesce(F.col("value"), _per_column(fills)).alias("value")
    )
    found = numbered(counts.filter(F.col("value").isNotNull()).distinct(), ["value"], ["column"], "index")
    return staged(found.select("column", "value", "index"), "levels")


def _per_column(values: dict[str, str]) -> Column:
    chosen = F.lit(None).cast("string")
    for c, v in values.items():
        chosen = F.when(F.col("column") == c, F.lit(v)).otherwise(chosen)
    return chosen


def slot(column: str, level: str) -> str:
    return f"{column}={level}"


# ---------------------------------------------------------------- stages


class Preprocessor(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Learns all fitted values from the rows it is given."""

    plan = Param(Params._dummy(), "plan", "feature plan as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, plan: str = "{}"):
        super().__init__()
        self._set(plan=plan)

    @staticmethod
    def of(plan: FeaturePlan) -> "Preprocessor":
        return Preprocessor(plan=json.dumps(asdict(plan)))

    def _fit(self, dataset: DataFrame) -> "PreprocessorModel":
        plan = FeaturePlan(**json.loads(self.getOrDefault(self.plan)))
        train = without_nan(months_as_text(dataset))
        state: dict = {"medians": {}, "moments": {}, "modes": {}, "levels": {}}
        dictionary = None
        if plan.numeric:
            state["medians"] = {r["column"]: r["median"] for r in medians(train, plan.numeric).collect()}
            if plan.scale:
                state["moments"] = {
                    r["column"]: (r["mean"], r["std"])
                    for r in moments(train, plan.numeric, state["medians"]).collect()
                }
        texts = [*plan.onehot, *plan.target_mean]
        if texts:
            state["modes"] = {r["column"]: r["mode"] for r in modes(train, texts).collect()}
        if plan.onehot:
            dictionary = levels(train, plan.onehot, state["modes"])
            found = {r["column"]: r["count"] for r in dictionary.groupBy("column").count().collect()}
            state["levels"] = {c: found.get(c, 0) for c in plan.onehot}
        means = None
        if plan.target_mean:
            means = staged(target_means(train, plan, state["modes"]), "target-means")
            # Number of values and global mean per column: the number decides how to join.
            facts = means.groupBy("column").agg(
                F.count("value").alias("rows"), F.max(F.when(F.col("value").isNull(), F.col("mean"))).alias("all")
            )
            state["means"] = {r["column"]: (r["rows"], r["all"]) for r in facts.collect()}
        model = PreprocessorModel(plan=json.dumps(asdict(plan)), state=json.dumps(state))
        model.means, model.dictionary = means, dictionary
        return model


class PreprocessorModel(Model, MLWritable, MLReadable):
    """Adds the encoded columns and the ``features`` vector; every row passes through."""

    plan = Param(Params._dummy(), "plan", "feature plan as JSON", TypeConverters.toString)
    state = Param(Params._dummy(), "state", "fitted values as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, plan: str = "{}", state: str = "{}"):
        super().__init__()
        self._set(plan=plan, state=state)
        self.means: DataFrame | None = None
        self.dictionary: DataFrame | None = None

    def fitted(self) -> tuple[FeaturePlan, dict]:
        return (
            FeaturePlan(**json.loads(self.getOrDefault(self.plan))),
            json.loads(self.getOrDefault(self.state)),
        )

    def slots(self) -> list[str]:
        """Names of the feature vector's slots, in order: for few slots."""
        plan, state = self.fitted()
        by_column: dict[str, list] = {c: [] for c in plan.onehot}
        if self.dictionary is not None:
            for r in bounded_rows(self.dictionary, MOST_NAMES, "slots with names"):
                by_column[r["column"]].append((r["index"], r["value"]))
        onehot = [slot(c, v) for c in plan.onehot for _, v in sorted(by_column[c])]
        return [*plan.numeric, *onehot, *[f"{c}_tmean" for c in plan.target_mean]]

    def _columns(self, df: DataFrame) -> DataFrame:
        """The input with ``_n_<i>`` per number, ``_s_<i>`` and ``_i_<i>`` (level and its index) per
        one-hot column, ``_t_<i>`` per target mean. The width doesn't grow with the levels."""
        plan, state = self.fitted()
        base = without_nan(months_as_text(df))

        def filled(c: str) -> Column:
            return F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(state["modes"].get(c)))

        cols = []
        for i, c in enumerate(plan.numeric):
            x = F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(state["medians"].get(c)))
            if plan.scale:
                mean, std = state["moments"][c]
                x = (x - F.lit(mean)) / F.lit(std or 1.0)
            cols.append(F.coalesce(x, F.lit(0.0)).alias(f"_n_{i}"))
        out = base.select("*", *cols, *[filled(c).alias(f"_s_{i}") for i, c in self._leveled()])
        for i, c in self._leveled():
            n = state["levels"][c]
            table = self.dictionary.filter(F.col("column") == c).select(F.col("value").alias("_value"), F.col("index").alias("_index"))
            # A value that was not seen, or none, has the last index, which is no slot.
            index = F.coalesce("_index", F.lit(n)).cast("double")
            out = lookup(out.withColumn("_value", F.col(f"_s_{i}")), table, "_value", n).withColumn(f"_i_{i}", index)
            out = out.withMetadata(f"_i_{i}", {"ml_attr": {"type": "nominal", "num_vals": n + 1}}).drop("_value", "_index")
        for i, c in enumerate(plan.target_mean):
            rows, everyone = state["means"].get(c, (0, 0.0))
            table = self.means.filter((F.col("column") == c) & F.col("value").isNotNull()).select(
                F.col("value").alias("_value"), F.col("mean").alias("_mean")
            )
            out = (
                lookup(out.withColumn("_value", filled(c)), table, "_value", rows)
                .withColumn(f"_t_{i}", F.coalesce("_mean", F.lit(everyone), F.lit(0.0)))
                .drop("_value", "_mean")
            )
        return out

    def _leveled(self) -> list[tuple[int, str]]:
        plan, state = self.fitted()
        return [(i, c) for i, c in enumerate(plan.onehot) if state["levels"][c]]

    def named(self, df: DataFrame, *keep: str) -> DataFrame:
        """The kept columns and one named column per slot: for few slots."""
        out = self.transform(df)
        values = vector_to_array("features")
        return out.select(*keep, *[F.get(values, F.lit(i)).alias(f"{n}") for i, n in enumerate(self.slots())])

    def entries(self, df: DataFrame, *keep: str) -> DataFrame:
        """(kept columns, slot, value) of the slots that are not zero, for any number of slots."""
        plan, state = self.fitted()
        parts = [(F.lit(c), F.col(f"_n_{i}")) for i, c in enumerate(plan.numeric)]
        for i, c in self._leveled():
            seen = (F.col(f"_i_{i}") < state["levels"][c]).cast("double")
            parts.append((F.concat(F.lit(slot(c, "")), F.coalesce(f"_s_{i}", F.lit(""))), seen))
        parts += [(F.lit(f"{c}_tmean"), F.col(f"_t_{i}")) for i, c in enumerate(plan.target_mean)]
        rows = F.array(*[F.struct(n.alias("slot"), v.alias("value")) for n, v in parts])
        out = self._columns(df).select(*keep, F.explode(rows).alias("e")).select(*keep, "e.slot", "e.value")
        return out.filter("value <> 0")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        plan, _ = self.fitted()
        out = self._columns(dataset)
        texts = [i for i, _ in self._leveled()]
        made = [c for c in out.columns if c.startswith(("_n_", "_s_", "_i_", "_t_")) and c not in dataset.columns]
        if texts:
            vectors = [f"_v_{i}" for i in texts]
            hot = OneHotEncoder(inputCols=[f"_i_{i}" for i in texts], outputCols=vectors, dropLast=True)
            out = hot.fit(out).transform(out)  # the sizes are in the columns' metadata: no job
            made += vectors
        names = [f"_n_{i}" for i in range(len(plan.numeric))] + [f"_v_{i}" for i in texts]
        names += [f"_t_{i}" for i in range(len(plan.target_mean))]
        return VectorAssembler(inputCols=names, outputCol="features").transform(out).drop(*made)

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    """Parameters as usual, the target means and the levels as tables beside them."""

    def __init__(self, model: PreprocessorModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        if self.model.means is not None:
            self.model.means.write.parquet(f"{path}/means")
        if self.model.dictionary is not None:
            self.model.dictionary.write.parquet(f"{path}/levels")


class _Reader(MLReader):
    def load(self, path: str) -> PreprocessorModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = PreprocessorModel()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        plan, _ = model.fitted()
        if plan.target_mean:
            model.means = self.sparkSession.read.parquet(f"{path}/means")
        if plan.onehot:
            model.dictionary = self.sparkSession.read.parquet(f"{path}/levels")
        return model
