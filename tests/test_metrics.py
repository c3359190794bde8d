import math

import numpy as np
import pandas as pd
import pytest

from lendframe.operators import metrics

N = 3000


def scored(seed, hot=True):
    r = np.random.default_rng(seed)
    label = r.integers(0, 2, N)
    score = np.round(np.clip(r.normal(0.45 + 0.1 * label, 0.2, N), 0, 1), 3)
    if hot:
        score[: N // 3] = 0.5
    return pd.DataFrame({"label": label, "score": score})


def auc(d):
    pos, neg = d.score[d.label == 1].to_numpy(), d.score[d.label == 0].to_numpy()
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return wins / (len(pos) * len(neg))


def average_precision(d):
    total, out, before = (d.label == 1).sum(), 0.0, 0.0
    for t in sorted(d.score.unique(), reverse=True):
        hit = d.score >= t
        recall = ((d.label == 1) & hit).sum() / total
        out += (recall - before) * ((d.label == 1) & hit).sum() / hit.sum()
        before = recall
    return out


def f1(d, t):
    hit = d.score >= t
    tp, fp, fn = ((d.label == 1) & hit).sum(), ((d.label == 0) & hit).sum(), ((d.label == 1) & ~hit).sum()
    return 2 * tp / (2 * tp + fp + fn) if tp + fp + fn else 0.0


def test_against_brute_force_with_a_hot_score(spark):
    d = scored(1)
    hist = metrics.score_histogram(spark.createDataFrame(d))
    row = metrics.ranking_metrics(hist).first()
    assert row["auc"] == pytest.approx(auc(d), abs=1e-12)
    assert row["pr_auc"] == pytest.approx(average_precision(d), abs=1e-12)
    p = d.score.clip(metrics.CLIP, 1 - metrics.CLIP)
    loss = -(d.label * np.log(p) + (1 - d.label) * np.log(1 - p)).mean()
    assert row["log_loss"] == pytest.approx(loss, abs=1e-9)
    values = [f1(d, t) for t in metrics.THRESHOLDS]
    best = metrics.best_threshold(hist).first()
    assert best["threshold"] == metrics.THRESHOLDS[int(np.argmax(values))]
    assert best["value"] == pytest.approx(max(values), abs=1e-12)


def test_groups_equal_separate_runs(spark):
    a, b = scored(2), scored(3, hot=False)
    both = metrics.compare({"a": spark.createDataFrame(a), "b": spark.createDataFrame(b)}).collect()
    assert [r["auc"] for r in both] == sorted((r["auc"] for r in both), reverse=True)
    for r in both:
        d = {"a": a, "b": b}[r["model"]]
        assert r["auc"] == pytest.approx(auc(d), abs=1e-12)
        assert r["f1"] == pytest.approx(f1(d, r["threshold"]), abs=1e-12)


def test_ranking_with_equal_scores_and_with_one_class(spark):
    same = spark.createDataFrame([(1, 0.3), (0, 0.3), (1, 0.3)], "label int, score double")
    assert metrics.ranking_metrics(metrics.score_histogram(same)).first()["auc"] == 0.5
    one = spark.createDataFrame([(1, 0.3), (1, 0.4)], "label int, score double")
    assert metrics.ranking_metrics(metrics.score_histogram(one)).first()["auc"] is None


def test_rows_without_label_are_left_out(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.1), (None, 0.5)], "label int, score double")
    assert metrics.ranking_metrics(metrics.score_histogram(df)).first()["rows"] == 2


def test_best_threshold_is_one_half_when_nothing_scores(spark):
    df = spark.createDataFrame([(0, 0.9), (0, 0.2)], "label int, score double")
    assert metrics.best_threshold(metrics.score_histogram(df)).first()["threshold"] == 0.5


def test_threshold_is_ignored_while_optimising_and_zero_is_a_threshold(spark):
    hist = metrics.score_histogram(spark.createDataFrame(scored(4)))
    best = metrics.best_threshold(hist).first()["threshold"]
    assert metrics.evaluate(hist, threshold=0.9).first()["threshold"] == best
    zero = metrics.evaluate(hist, threshold=0.0, optimize_threshold=False).first()
    assert (zero["threshold"], zero["fn"], zero["tn"]) == (0.0, 0, 0)
    assert metrics.evaluate(hist, optimize_threshold=False).first()["threshold"] == 0.5


def test_zero_denominators_give_zero(spark):
    counts = spark.createDataFrame([(5, 0, 0, 0)], "tn bigint, fp bigint, fn bigint, tp bigint")
    row = metrics.class_metrics(counts).first()
    assert (row["precision"], row["recall"], row["f1"], row["specificity"]) == (0.0, 0.0, 0.0, 1.0)


def test_curves(spark):
    d = scored(5)
    hist = metrics.score_histogram(spark.createDataFrame(d))
    roc = sorted((r["fpr"], r["tpr"], r["threshold"]) for r in metrics.roc_curve(hist).collect())
    assert len(roc) == d.score.nunique() + 1
    assert roc[0] == (0.0, 0.0, math.inf) and roc[-1][:2] == (1.0, 1.0)
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(roc, roc[1:]))
    assert area == pytest.approx(auc(d), abs=1e-9)
    short = sorted((r["fpr"], r["tpr"]) for r in metrics.roc_curve(hist, drop_collinear=True).collect())
    assert len(short) <= len(roc)
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(short, short[1:]))
    assert area == pytest.approx(auc(d), abs=1e-9)
    pr = metrics.pr_curve(hist).collect()
    assert [(r["precision"], r["recall"]) for r in pr if r["threshold"] is None] == [(1.0, 0.0)]


def test_no_single_task_window_over_rows(spark):
    hist = metrics.score_histogram(spark.createDataFrame(scored(6)))
    plan = metrics.ranking_metrics(hist)._jdf.queryExecution().executedPlan().toString()
    for line in plan.splitlines():
        if "Window [" in line and "score" in line:
            assert "[_range" in line
