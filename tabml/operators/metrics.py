"""Exact classification metrics from scored rows: ``y`` (0/1) and ``score``.

Every function takes ``by`` columns, so that all models, classes or folds are
evaluated in one job. Rank-based metrics work on score groups through
``running_totals``; scored rows are never sorted as a whole or collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabml.functions.ordered import running_totals
from tabml.functions.scalars import clipped, ratio, rescaled

# Accepted spellings of the metrics.
METRIC_NAMES = {
    "auprc": "auprc",
    "pr_auc": "auprc",
    "average_precision": "auprc",
    "auroc": "auroc",
    "roc_auc": "auroc",
    "precision": "precision",
    "recall": "recall",
    "f1": "f1",
}
GRID = [i / 100 for i in range(1, 100)]
EDGE = 1e-9


def metric_name(name: str | None) -> str:
    """The canonical name; an unknown one is an error, not a silent default."""
    wanted = (name or "auprc").lower()
    if wanted not in METRIC_NAMES:
        raise ValueError(f"unknown metric {name!r}")
    return METRIC_NAMES[wanted]


def _score_totals(scored: DataFrame, by: list[str]) -> DataFrame:
    y = F.col("y").cast("long")
    return running_totals(
        scored, by, "score", {"pos": F.sum(y), "neg": F.sum(1 - y)}, descending=True
    )


def curve_points(scored: DataFrame, by: list[str] = ()) -> DataFrame:
    """Precision and recall at every distinct score, with ``>=`` as the rule."""
    t = _score_totals(scored, list(by))
    return t.select(
        *by,
        F.col("score").alias("threshold"),
        ratio(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg")).alias("precision"),
        ratio(F.col("cum_pos"), F.col("all_pos")).alias("recall"),
    )


def ranking_metrics(scored: DataFrame, by: list[str] = ()) -> DataFrame:
    """Average precision (step sum) and ROC AUC (ties count half) per group.

    NULL where a group holds one class only.
    """
    t = _score_totals(scored, list(by))
    pos, neg = F.col("all_pos"), F.col("all_neg")
    step = F.col("pos") * ratio(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg"))
    below = F.col("pos") * ((neg - F.col("cum_neg")) + F.col("neg") / 2.0)
    sums = t.groupBy(*by).agg(
        F.sum(step).alias("steps"),
        F.sum(below).alias("pairs"),
        F.max(pos).cast("double").alias("p"),
        F.max(neg).cast("double").alias("n"),
    )
    both = (F.col("p") > 0) & (F.col("n") > 0)
    return sums.select(
        *by,
        F.when(F.col("p") > 0, F.col("steps") / F.nullif("p", F.lit(0.0))).alias("auprc"),
        F.when(both, F.col("pairs") / F.nullif(F.col("p") * F.col("n"), F.lit(0.0))).alias("auroc"),
    )


def rates(tp: Column, fp: Column, fn: Column) -> list[Column]:
    return [
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    ]


def confusion(scored: DataFrame, threshold: Column | float, by: list[str] = ()) -> DataFrame:
    """tn, fp, fn, tp, precision, recall and F1 at a threshold (a number or a column)."""
    cut = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    yes, said = F.col("y") == 1, F.col("score") >= cut
    counts = scored.groupBy(*by).agg(
        F.count_if(~yes & ~said).alias("tn"),
        F.count_if(~yes & said).alias("fp"),
        F.count_if(yes & ~said).alias("fn"),
        F.count_if(yes & said).alias("tp"),
    )
    return counts.select("*", *rates(F.col("tp"), F.col("fp"), F.col("fn")))


def brier(scored: DataFrame, by: list[str] = ()) -> DataFrame:
    gap = F.col("score") - F.col("y")
    return scored.groupBy(*by).agg(F.avg(gap * gap).alias("brier"))


def log_loss(scored: DataFrame, by: list[str] = (), edge: float = 1e-15) -> DataFrame:
    p = clipped(F.col("score"), edge, 1 - edge)
    loss = -F.when(F.col("y") == 1, F.log(p)).otherwise(F.log(1 - p))
    return scored.groupBy(*by).agg(F.avg(loss).alias("log_loss"))


def balanced_accuracy(scored: DataFrame, threshold: float, by: list[str] = ()) -> DataFrame:
    c = confusion(scored, threshold, by)
    hit = ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    miss = ratio(F.col("tn"), F.col("tn") + F.col("fp"))
    return c.select(*by, ((hit + miss) / 2).alias("balanced_accuracy"))


def residuals(scored: DataFrame, by: list[str] = ()) -> DataFrame:
    """n, RMSE, MAE and R² of ``score`` against the number ``y``; R² is NULL where y doesn't vary.

    One pass: the spread of y comes from its variance, which is summed around a running mean.
    """
    gap = F.col("y") - F.col("score")
    sums = scored.filter(F.col("y").isNotNull() & F.col("score").isNotNull()).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.avg(gap * gap).alias("square"), F.avg(F.abs(gap)).alias("mae"), F.var_pop("y").alias("spread")
    )
    return sums.select(
        *by, "n", F.sqrt("square").alias("rmse"), "mae", F.when(F.col("spread") > 0, 1 - F.col("square") / F.col("spread")).alias("r2")
    )


def best_threshold(scored: DataFrame, min_recall: float = 0.6, by: list[str] = ()) -> DataFrame:
    """The threshold with the highest F1 among those with enough recall.

    Candidates are all distinct scores and a 0.01 grid, clipped into (0, 1). Ties go to
    the lowest threshold. If none reaches the recall floor, the one with the highest
    recall, then F1, is taken and ``violated`` is set.
    """
    by = list(by)
    y = F.col("y").cast("long")
    inner = clipped(F.col("score"), EDGE, 1 - EDGE)

    def row(at: Column, pos: Column, neg: Column, candidate: Column) -> Column:
        return F.struct(
            at.alias("t"), pos.alias("pos"), neg.alias("neg"), candidate.alias("candidate")
        )

    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    own = row(F.col("score"), y, 1 - y, F.when(inner == F.col("score"), one).otherwise(zero))
    moved = row(inner, zero, zero, one)
    rows = scored.filter(F.col("score").isNotNull()).select(
        *by,
        F.explode(
            F.when(inner == F.col("score"), F.array(own)).otherwise(F.array(own, moved))
        ).alias("r"),
    )
    groups = scored.select(*by).distinct() if by else scored.sparkSession.range(1).select()
    grid = groups.select(
        *by, F.explode(F.array(*[F.lit(g) for g in GRID])).alias("t")
    ).select(*by, row(F.col("t"), zero, zero, one).alias("r"))
    both = rows.unionByName(grid).select(*by, "r.t", "r.pos", "r.neg", "r.candidate")
    sums = {"pos": F.sum("pos"), "neg": F.sum("neg"), "candidate": F.max("candidate")}
    t = running_totals(both, by, "t", sums, descending=True).filter("candidate = 1")

    tp, fp = F.col("cum_pos"), F.col("cum_neg")
    points = t.select(*by, "t", *rates(tp, fp, F.col("all_pos") - tp))
    ok = F.col("recall") + 1e-12 >= F.lit(float(min_recall))
    best = points.groupBy(*by).agg(
        F.max(
            F.struct(
                ok.alias("ok"),
                F.when(ok, F.col("f1")).otherwise(F.col("recall")).alias("first"),
                F.when(ok, 0.0).otherwise(F.col("f1")).alias("second"),
                (-F.col("t")).alias("low"),
                "t",
                "precision",
                "recall",
                "f1",
            )
        ).alias("b")
    )
    return best.select(
        *by,
        F.col("b.t").alias("threshold"),
        "b.precision",
        "b.recall",
        "b.f1",
        (~F.col("b.ok")).alias("violated"),
    )


def one_vs_rest(scored: DataFrame, actual: str, class_scores: dict[object, str], by: list[str] = ()) -> DataFrame:
    """(by, class, y, score) rows: one per input row and class."""
    pairs = [
        F.struct(
            F.lit(k).alias("class"),
            (F.col(actual) == F.lit(k)).cast("int").alias("y"),
            F.col(c).cast("double").alias("score"),
        )
        for k, c in class_scores.items()
    ]
    return scored.select(*by, F.explode(F.array(*pairs)).alias("p")).select(
        *by, "p.class", "p.y", "p.score"
    )


def macro_ranking(rows: DataFrame, by: list[str] = ()) -> DataFrame:
    """Mean over the classes that occur, from ``one_vs_rest`` rows."""
    per_class = ranking_metrics(rows, [*by, "class"]).filter(F.col("auprc").isNotNull())
    return per_class.groupBy(*by).agg(
        F.avg("auprc").alias("auprc"), F.avg("auroc").alias("auroc")
    )


def macro_f1(predicted: DataFrame, actual: str, guess: str, by: list[str] = ()) -> DataFrame:
    """Unweighted mean F1 over all actual and predicted classes."""
    pairs = predicted.groupBy(*by, actual, guess).agg(F.count(F.lit(1)).alias("n"))
    hit = F.col(actual) == F.col(guess)
    role = lambda k, tp, fp, fn: F.struct(
        k.alias("class"), tp.alias("tp"), fp.alias("fp"), fn.alias("fn")
    )
    n, zero = F.col("n"), F.lit(0).cast("long")
    roles = F.when(hit, F.array(role(F.col(actual), n, zero, zero))).otherwise(
        F.array(role(F.col(actual), zero, zero, n), role(F.col(guess), zero, n, zero))
    )
    per_class = (
        pairs.select(*by, F.explode(roles).alias("r"))
        .groupBy(*by, "r.class")
        .agg(F.sum("r.tp").alias("tp"), F.sum("r.fp").alias("fp"), F.sum("r.fn").alias("fn"))
    )
    f1 = ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))
    return per_class.groupBy(*by).agg(F.avg(f1).alias("f1"))


def rescaled_scores(raw: DataFrame, column: str, out: str = "score") -> DataFrame:
    """Decision values min-max scaled into [0, 1]."""
    ends = raw.agg(F.struct(F.min(column).alias("lo"), F.max(column).alias("hi")).alias("e"))
    edges = ends.select("e").scalar()
    return (
        raw.withColumn("_e", edges)
        .withColumn(out, rescaled(F.col(column), F.col("_e.lo"), F.col("_e.hi")))
        .drop("_e")
    )
