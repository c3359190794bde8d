"""Queries: metrics over a deterministic score table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendframe.functions.cleaning import stable_hash, target_code
from lendframe.operators import metrics
from lendframe.plans.catalog import SCORE_PARTS, query
from lendframe.plans.loans import loans

RANKED = (*SCORE_PARTS, "ranked")


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(loan_id, label, score): a score made from the row key, higher for repaid loans."""
    rows = loans(spark, sf_dir, ["loan_id", "loan_status"]).select(
        "loan_id", target_code(F.col("loan_status")).alias("label")
    )
    drawn = stable_hash(F.col("loan_id"), 42) % 800 + F.col("label") * 150 + 25
    return rows.filter("label IS NOT NULL").withColumn("score", drawn / F.lit(1000.0))


def hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.score_histogram(scores(spark, sf_dir))


def _rounded(df: DataFrame, columns: list[str], digits: int = 9) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _counts(at: str) -> str:
    return (
        f"SELECT CAST(sum(neg) FILTER (WHERE score < {at}) AS BIGINT) AS tn, "
        f"CAST(sum(neg) FILTER (WHERE score >= {at}) AS BIGINT) AS fp, "
        f"CAST(sum(pos) FILTER (WHERE score < {at}) AS BIGINT) AS fn, "
        f"CAST(sum(pos) FILTER (WHERE score >= {at}) AS BIGINT) AS tp FROM hist"
    )


_LIST = ", ".join(f"({t!r}e0)" for t in metrics.THRESHOLDS)


def _grid(hist_name: str = "hist") -> str:
    """SQL: counts per candidate threshold."""
    return (
        "SELECT threshold, CAST(sum(CASE WHEN score < threshold THEN neg ELSE 0 END) AS DOUBLE) AS tn, "
        "CAST(sum(CASE WHEN score >= threshold THEN neg ELSE 0 END) AS DOUBLE) AS fp, "
        "CAST(sum(CASE WHEN score < threshold THEN pos ELSE 0 END) AS DOUBLE) AS fn, "
        "CAST(sum(CASE WHEN score >= threshold THEN pos ELSE 0 END) AS DOUBLE) AS tp "
        f"FROM {hist_name}, (VALUES {_LIST}) t(threshold) GROUP BY threshold"
    )


_F1 = "coalesce(2e0 * tp / nullif(2e0 * tp + fp + fn, 0), 0e0)"
_RECALL = "coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0e0)"
_SPEC = "coalesce(CAST(tn AS DOUBLE) / nullif(tn + fp, 0), 0e0)"
_PRECISION = "coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0e0)"
_ACCURACY = "CAST(tp + tn AS DOUBLE) / (tn + fp + fn + tp)"
_CLASS = {
    "accuracy": _ACCURACY,
    "precision": _PRECISION,
    "recall": _RECALL,
    "f1": _F1,
    "specificity": _SPEC,
    "balanced_accuracy": f"({_RECALL} + {_SPEC}) / 2e0",
}
_AUC = "sum(neg * (tp - pos / 2e0)) / (max(p_all) * max(n_all))"
_AP = "sum(pos * (tp / (tp + fp))) / max(p_all)"
_P = "least(greatest(score, 2.220446049250313e-16), 1e0 - 2.220446049250313e-16)"
_LOSS = f"sum(-(pos * ln({_P}) + neg * ln(1e0 - {_P}))) / (max(p_all) + max(n_all))"


@query("confusion", _counts("5e-1"), SCORE_PARTS)
def confusion(spark, sf_dir):
    return metrics.confusion(hist(spark, sf_dir), 0.5)


@query(
    "class_metrics",
    f"WITH c AS ({_counts('5e-1')}) SELECT c.*, "
    + ", ".join(f"round({sql}, 9) AS {name}" for name, sql in _CLASS.items())
    + " FROM c",
    SCORE_PARTS,
)
def class_metrics(spark, sf_dir):
    found = metrics.class_metrics(metrics.confusion(hist(spark, sf_dir), 0.5))
    return _rounded(found, list(_CLASS))


@query("roc_auc", f"SELECT round({_AUC}, 9) AS auc FROM ranked", RANKED)
def roc_auc(spark, sf_dir):
    return metrics.ranking_metrics(hist(spark, sf_dir)).select(F.round("auc", 9).alias("auc"))


@query("avg_precision", f"SELECT round({_AP}, 9) AS pr_auc FROM ranked", RANKED)
def avg_precision(spark, sf_dir):
    return metrics.ranking_metrics(hist(spark, sf_dir)).select(F.round("pr_auc", 9).alias("pr_auc"))


@query("log_loss", f"SELECT round({_LOSS}, 9) AS log_loss FROM ranked", RANKED)
def log_loss(spark, sf_dir):
    return metrics.ranking_metrics(hist(spark, sf_dir)).select(F.round("log_loss", 9).alias("log_loss"))


_ROC_START = "SELECT CAST('inf' AS DOUBLE) AS threshold, 0e0 AS fpr, 0e0 AS tpr"


@query(
    "roc_curve",
    f"SELECT score AS threshold, fp / n_all AS fpr, tp / p_all AS tpr FROM ranked UNION ALL {_ROC_START}",
    RANKED,
)
def roc_curve(spark, sf_dir):
    return metrics.roc_curve(hist(spark, sf_dir))


@query(
    "roc_curve_turning",
    "WITH s AS (SELECT *, lead(pos) OVER (ORDER BY score DESC) AS p2, lead(neg) OVER (ORDER BY score DESC) AS n2 "
    "FROM ranked) SELECT score AS threshold, fp / n_all AS fpr, tp / p_all AS tpr FROM s "
    f"WHERE p2 IS NULL OR p2 <> pos OR n2 <> neg UNION ALL {_ROC_START}",
    RANKED,
)
def roc_curve_turning(spark, sf_dir):
    return metrics.roc_curve(hist(spark, sf_dir), drop_collinear=True)


@query(
    "pr_curve",
    "SELECT score AS threshold, tp / (tp + fp) AS precision, tp / p_all AS recall FROM ranked UNION ALL "
    "SELECT CAST(NULL AS DOUBLE), 1e0, 0e0",
    RANKED,
)
def pr_curve(spark, sf_dir):
    return metrics.pr_curve(hist(spark, sf_dir))


@query(
    "class_report",
    f"WITH c AS ({_counts('5e-1')}), r AS (SELECT '0' AS class, "
    "coalesce(CAST(tn AS DOUBLE) / nullif(tn + fn, 0), 0) AS precision, "
    "coalesce(CAST(tn AS DOUBLE) / nullif(tn + fp, 0), 0) AS recall, "
    "coalesce(2e0 * tn / nullif(2 * tn + fn + fp, 0), 0) AS f1, tn + fp AS support FROM c UNION ALL "
    f"SELECT '1', {_PRECISION}, {_RECALL}, {_F1}, tp + fn FROM c), a AS (SELECT * FROM r UNION ALL "
    "SELECT 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM r UNION ALL "
    "SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support), "
    "sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM r) "
    "SELECT class, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1, support FROM a",
    SCORE_PARTS,
)
def class_report(spark, sf_dir):
    found = metrics.class_report(metrics.confusion(hist(spark, sf_dir), 0.5))
    return _rounded(found, ["precision", "recall", "f1"])


_OBJECTIVES = {"f1": _F1, "youden": f"{_RECALL} + {_SPEC} - 1e0", "balanced": f"({_RECALL} + {_SPEC}) / 2e0"}


@query(
    "best_threshold",
    f"WITH g AS ({_grid()}), s AS ("
    + " UNION ALL ".join(f"SELECT '{o}' AS objective, threshold, {sql} AS v FROM g" for o, sql in _OBJECTIVES.items())
    + "), r AS (SELECT *, row_number() OVER (PARTITION BY objective ORDER BY v DESC, threshold) AS k FROM s) "
    "SELECT objective, threshold, round(v, 9) AS value FROM r WHERE k = 1",
    SCORE_PARTS,
)
def best_threshold(spark, sf_dir):
    h = hist(spark, sf_dir)
    out = None
    for o in _OBJECTIVES:
        part = metrics.best_threshold(h, o).select(
            F.lit(o).alias("objective"), "threshold", F.round("value", 9).alias("value")
        )
        out = part if out is None else out.unionByName(part)
    return out


_BEST = f"(SELECT threshold FROM ({_grid()}) g ORDER BY {_F1} DESC, threshold LIMIT 1)"
_EVALUATED = {
    "tn": "CAST(tn AS DOUBLE)", "fp": "CAST(fp AS DOUBLE)", "fn": "CAST(fn AS DOUBLE)", "tp": "CAST(tp AS DOUBLE)",
    **_CLASS, "auc": "auc", "pr_auc": "ap", "log_loss": "loss", "threshold": "cut",
}


@query(
    "evaluation_summary",
    f"WITH best AS (SELECT {_BEST} AS cut), c AS ({_counts('(SELECT cut FROM best)')}), "
    f"r AS (SELECT {_AUC} AS auc, {_AP} AS ap, {_LOSS} AS loss FROM ranked) "
    + " UNION ALL ".join(
        f"SELECT '{name}' AS metric, round({sql}, 9) AS value FROM c, r, best" for name, sql in _EVALUATED.items()
    ),
    RANKED,
)
def evaluation_summary(spark, sf_dir):
    return _rounded(metrics.long_metrics(metrics.evaluate(hist(spark, sf_dir))), ["value"])


def _model_sql(name: str, score: str) -> str:
    """SQL: one evaluated row for a score expression."""
    h = f"h_{name}"
    return (
        f"{h} AS (SELECT {score} AS score, count(*) FILTER (WHERE label = 1) AS pos, "
        f"count(*) FILTER (WHERE label = 0) AS neg FROM scores GROUP BY 1), "
        f"r_{name} AS (SELECT *, CAST(sum(pos) OVER w AS DOUBLE) AS tp, CAST(sum(neg) OVER w AS DOUBLE) AS fp, "
        "CAST(sum(pos) OVER () AS DOUBLE) AS p_all, CAST(sum(neg) OVER () AS DOUBLE) AS n_all "
        f"FROM {h} WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING)), "
        f"g_{name} AS (SELECT * FROM ({_grid(h)}) g ORDER BY {_F1} DESC, threshold LIMIT 1), "
        f"m_{name} AS (SELECT {_AUC} AS auc, {_AP} AS pr_auc, {_LOSS} AS log_loss FROM r_{name})"
    )


@query(
    "compare_models",
    f"WITH {_model_sql('plain', 'score')}, {_model_sql('coarse', 'round(score * 1e1) / 1e1')} "
    + " UNION ALL ".join(
        f"SELECT '{m}' AS model, "
        + ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in ("tn", "fp", "fn", "tp"))
        + ", "
        + ", ".join(f"round({sql}, 9) AS {n}" for n, sql in _CLASS.items())
        + ", round(auc, 9) AS auc, round(pr_auc, 9) AS pr_auc, round(log_loss, 9) AS log_loss, threshold "
        f"FROM g_{m}, m_{m}"
        for m in ("plain", "coarse")
    ),
    ("loans", "scores"),
)
def compare_models(spark, sf_dir):
    plain = scores(spark, sf_dir)
    coarse = plain.withColumn("score", F.round(F.col("score") * 10.0) / 10.0)
    return _rounded(metrics.compare({"plain": plain, "coarse": coarse}), metrics.METRICS)
