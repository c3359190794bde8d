"""Ranking and threshold metrics of a scored table.

Rows collapse once to a score histogram (score, pos, neg); everything else is computed from it, so
the scored table is read a single time whatever is asked. `groups` (for instance a model name)
must come from a list fixed by the caller.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendframe.operators.ranking import running_totals

# Candidate thresholds and the clip of the log loss.
THRESHOLDS = [float(t) for t in np.linspace(0.1, 0.9, 50)]
DEFAULT_THRESHOLD = 0.5
CLIP = float(np.finfo(np.float64).eps)
METRICS = [
    "accuracy",
    "precision",
    "recall",
    "f1",
    "auc",
    "pr_auc",
    "log_loss",
    "specificity",
    "balanced_accuracy",
]


def score_histogram(
    scored: DataFrame, score: str = "score", label: str = "label", groups: Sequence[str] = ()
) -> DataFrame:
    """(groups..., score, pos, neg); rows without a label are left out."""
    y = F.col(label)
    return (
        scored.filter(y.isNotNull() & F.col(score).isNotNull())
        .groupBy(*groups, F.col(score).cast("double").alias("score"))
        .agg(F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg"))
    )


def ratio(a: Column, b: Column) -> Column:
    """a / b, 0 when b is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def ranked(hist: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """Histogram with counts of positives and negatives at or above each score."""
    return running_totals(
        hist, "score", ["pos", "neg"], groups, descending=True, bounded_groups=True
    )


def ranking_metrics(hist: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """(groups..., auc, pr_auc, log_loss, rows); NULL where only one class is present.

    `auc` counts ties as half. `pr_auc` is the step sum of precision over recall gains.
    """
    r = ranked(hist, groups)
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    all_pos, all_neg = F.max("pos_total").cast("double"), F.max("neg_total").cast("double")
    above = F.col("pos_upto") - pos / 2
    precision = F.col("pos_upto") / (F.col("pos_upto") + F.col("neg_upto"))
    p = F.least(F.greatest(F.col("score"), F.lit(CLIP)), F.lit(1.0 - CLIP))
    loss = -(pos * F.ln(p) + neg * F.ln(F.lit(1.0) - p))
    return r.groupBy(*groups).agg(
        F.try_divide(F.sum(neg * above), all_pos * all_neg).alias("auc"),
        F.try_divide(F.sum(pos * precision), all_pos).alias("pr_auc"),
        F.try_divide(F.sum(loss), all_pos + all_neg).alias("log_loss"),
        (F.max("pos_total") + F.max("neg_total")).alias("rows"),
    )


def roc_curve(hist: DataFrame, groups: Sequence[str] = (), drop_collinear: bool = False) -> DataFrame:
    """(groups..., threshold, fpr, tpr), one row per distinct score plus (inf, 0, 0).

    `drop_collinear=True` also leaves out inner points on a straight line between their neighbours,
    which changes neither the drawn curve nor its area.
    """
    r = ranked(hist, groups)
    if drop_collinear:
        r = _turning_points(hist, r, groups)
    points = r.select(
        *groups,
        F.col("score").alias("threshold"),
        ratio(F.col("neg_upto"), F.col("neg_total")).alias("fpr"),
        ratio(F.col("pos_upto"), F.col("pos_total")).alias("tpr"),
    )
    start = (hist.select(*groups).distinct() if groups else hist.limit(1)).select(
        *groups,
        F.lit(float("inf")).alias("threshold"),
        F.lit(0.0).alias("fpr"),
        F.lit(0.0).alias("tpr"),
    )
    return points.unionByName(start)


def _turning_points(hist: DataFrame, r: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Keep a point when the step after it differs from the step into it, and the last point.

    The step after a score is the histogram row of the next lower score. It is found by rank, with
    an equi-join, because a plain `lead` over the whole table would run in one task.
    """
    numbered = running_totals(
        hist.withColumn("one", F.lit(1).cast("bigint")),
        "score",
        ["one"],
        groups,
        descending=True,
        bounded_groups=True,
    )
    following = numbered.select(
        *groups,
        (F.col("one_upto") - 1).alias("one_upto"),
        F.col("pos").alias("_next_pos"),
        F.col("neg").alias("_next_neg"),
    )
    steps = numbered.join(following, [*groups, "one_upto"], "left").select(
        *groups, "score", "_next_pos", "_next_neg"
    )
    straight = (F.col("_next_pos") == F.col("pos")) & (F.col("_next_neg") == F.col("neg"))
    return (
        r.join(steps, [*groups, "score"])
        .filter(~F.coalesce(straight, F.lit(False)))
        .drop("_next_pos", "_next_neg")
    )


def pr_curve(hist: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """(groups..., threshold, precision, recall), one row per distinct score plus (NULL, 1, 0)."""
    points = ranked(hist, groups).select(
        *groups,
        F.col("score").alias("threshold"),
        ratio(F.col("pos_upto"), F.col("pos_upto") + F.col("neg_upto")).alias("precision"),
        ratio(F.col("pos_upto"), F.col("pos_total")).alias("recall"),
    )
    end = (hist.select(*groups).distinct() if groups else hist.limit(1)).select(
        *groups,
        F.lit(None).cast("double").alias("threshold"),
        F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"),
    )
    return points.unionByName(end)


def threshold_counts(
    hist: DataFrame, groups: Sequence[str] = (), thresholds: Sequence[float] = THRESHOLDS
) -> DataFrame:
    """(groups..., threshold, tn, fp, fn, tp) for every candidate threshold.

    Each score is placed once among the thresholds, leaving at most len(thresholds) + 1 partial
    counts per group; the counts per threshold are suffix sums over those.
    """
    cuts = F.array(*[F.lit(float(t)) for t in sorted(thresholds)])
    slots = (
        hist.withColumn("_slot", F.size(F.filter(cuts, lambda t: t <= F.col("score"))))
        .groupBy(*groups, "_slot")
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    )
    packed = slots.groupBy(*groups).agg(
        F.collect_list(F.struct("_slot", "pos", "neg")).alias("_slots"),
        F.sum("pos").alias("_pos"),
        F.sum("neg").alias("_neg"),
    )

    def above(i: Column, name: str) -> Column:
        return F.aggregate(
            "_slots",
            F.lit(0).cast("bigint"),
            lambda acc, s: acc + F.when(s["_slot"] > i, s[name]).otherwise(F.lit(0)),
        )

    return (
        packed.select("*", F.posexplode(cuts).alias("_i", "threshold"))
        .withColumns({"tp": above(F.col("_i"), "pos"), "fp": above(F.col("_i"), "neg")})
        .select(
            *groups,
            "threshold",
            (F.col("_neg") - F.col("fp")).alias("tn"),
            "fp",
            (F.col("_pos") - F.col("tp")).alias("fn"),
            "tp",
        )
    )


def confusion(
    hist: DataFrame, threshold: float | str = DEFAULT_THRESHOLD, groups: Sequence[str] = ()
) -> DataFrame:
    """(groups..., tn, fp, fn, tp); `threshold` is a number or the name of a histogram column."""
    cut = F.col(threshold) if isinstance(threshold, str) else F.lit(float(threshold))
    hit = F.col("score") >= cut
    zero = F.lit(0)
    return hist.groupBy(*groups).agg(
        F.sum(F.when(hit, zero).otherwise(F.col("neg"))).alias("tn"),
        F.sum(F.when(hit, F.col("neg")).otherwise(zero)).alias("fp"),
        F.sum(F.when(hit, zero).otherwise(F.col("pos"))).alias("fn"),
        F.sum(F.when(hit, F.col("pos")).otherwise(zero)).alias("tp"),
    )


def class_metric_columns() -> dict[str, Column]:
    """Expressions over tn, fp, fn, tp; a zero denominator gives 0."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    recall, specificity = ratio(tp, tp + fn), ratio(tn, tn + fp)
    return {
        "accuracy": ratio(tp + tn, tn + fp + fn + tp),
        "precision": ratio(tp, tp + fp),
        "recall": recall,
        "f1": ratio(tp * 2, tp * 2 + fp + fn),
        "specificity": specificity,
        "balanced_accuracy": (recall + specificity) / 2,
    }


def class_metrics(counts: DataFrame) -> DataFrame:
    return counts.withColumns(class_metric_columns())


def class_report(counts: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """(groups..., class, precision, recall, f1, support): both classes, macro and weighted means."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))

    def entry(precision: Column, recall: Column, f1: Column, support: Column) -> Column:
        return F.struct(
            precision.alias("precision"),
            recall.alias("recall"),
            f1.alias("f1"),
            support.cast("bigint").alias("support"),
        )

    both = counts.select(
        *groups,
        entry(
            ratio(tn, tn + fn), ratio(tn, tn + fp), ratio(tn * 2, tn * 2 + fn + fp), tn + fp
        ).alias("a"),
        entry(
            ratio(tp, tp + fp), ratio(tp, tp + fn), ratio(tp * 2, tp * 2 + fp + fn), tp + fn
        ).alias("b"),
    )
    a, b = F.col("a"), F.col("b")
    n = a["support"] + b["support"]

    def mean(weighted: bool) -> Column:
        def one(name: str) -> Column:
            if weighted:
                return ratio(a[name] * a["support"] + b[name] * b["support"], n)
            return (a[name] + b[name]) / 2

        return entry(one("precision"), one("recall"), one("f1"), n)

    rows = [("0", a), ("1", b), ("macro avg", mean(False)), ("weighted avg", mean(True))]
    packed = F.array(*[F.struct(F.lit(name).alias("class"), s.alias("s")) for name, s in rows])
    return both.select(*groups, F.explode(packed).alias("r")).select(*groups, "r.class", "r.s.*")


def _objective(name: str) -> Column:
    m = class_metric_columns()
    if name == "youden":
        return m["recall"] + m["specificity"] - 1
    if name == "balanced":
        return m["balanced_accuracy"]
    return m["f1"]


def best_threshold(
    hist: DataFrame,
    objective: str = "f1",
    groups: Sequence[str] = (),
    thresholds: Sequence[float] = THRESHOLDS,
) -> DataFrame:
    """(groups..., threshold, value): the lowest threshold with the highest objective.

    0.5 when no threshold scores above 0.
    """
    scored = threshold_counts(hist, groups, thresholds).withColumn("value", _objective(objective))
    best = scored.groupBy(*groups).agg(
        F.max(F.struct("value", (-F.col("threshold")).alias("m"))).alias("_b")
    )
    found = F.col("_b.value") > 0
    return best.select(
        *groups,
        F.when(found, -F.col("_b.m")).otherwise(F.lit(DEFAULT_THRESHOLD)).alias("threshold"),
        F.when(found, F.col("_b.value")).otherwise(F.lit(0.0)).alias("value"),
    )


def evaluate(
    hist: DataFrame,
    groups: Sequence[str] = (),
    threshold: float | None = None,
    optimize_threshold: bool = True,
    objective: str = "f1",
) -> DataFrame:
    """(groups..., tn, fp, fn, tp, <METRICS>, threshold), one row per group.

    While `optimize_threshold` is on, the best threshold replaces the one passed in.
    """
    groups = list(groups)
    if optimize_threshold:
        best = best_threshold(hist, objective, groups).drop("value").withColumnRenamed(
            "threshold", "_cut"
        )
        cut = (
            hist.join(F.broadcast(best), groups)
            if groups
            else hist.withColumn("_cut", best.scalar())
        )
    else:
        value = DEFAULT_THRESHOLD if threshold is None else float(threshold)
        cut = hist.withColumn("_cut", F.lit(value))
    counts = confusion(cut, "_cut", [*groups, "_cut"])
    rank = ranking_metrics(hist, groups).drop("rows")
    if groups:
        joined = class_metrics(counts).join(F.broadcast(rank), groups)
    else:
        packed = rank.select(F.struct(*rank.columns))
        joined = (
            class_metrics(counts)
            .withColumn("_r", packed.scalar())
            .select("*", "_r.*")
            .drop("_r")
        )
    return joined.select(
        *groups, "tn", "fp", "fn", "tp", *METRICS, F.col("_cut").alias("threshold")
    )


def long_metrics(wide: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """(groups..., metric, value) from `evaluate`."""
    names = [c for c in wide.columns if c not in groups]
    return wide.select(*groups, *[F.col(c).cast("double").alias(c) for c in names]).unpivot(
        list(groups), names, "metric", "value"
    )


def compare(scored_models: Mapping[str, DataFrame], score: str = "score", label: str = "label") -> DataFrame:
    """One `evaluate` row per named scored table, best AUC first."""
    parts = [
        df.select(F.lit(name).alias("model"), score, label) for name, df in scored_models.items()
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    result = evaluate(score_histogram(rows, score, label, ["model"]), ["model"])
    return result.orderBy(F.desc("auc"), "model")
