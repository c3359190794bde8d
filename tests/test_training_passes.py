import threading
import time

import pytest

from lendframe.operators import metrics, search, train
from lendframe.operators.prepare import PreparationEstimator
from lendframe.plans import all_queries, preparation

TINY = {"n_estimators": 2, "max_depth": 2, "learning_rate": 0.3, "subsample": 1.0, "colsample_bytree": 1.0}


@pytest.fixture(scope="module")
def prepared(raw):
    return PreparationEstimator(2025).fit(raw).transform(raw).cache()


def seen(monkeypatch, module, name):
    """First arguments that `name` is called with from here on."""
    found, real = [], getattr(module, name)

    def spy(first, *rest, **options):
        found.append(first)
        return real(first, *rest, **options)

    monkeypatch.setattr(module, name, spy)
    return found


def test_held_out_rows_are_scored_once_per_cross_validation(prepared, monkeypatch):
    hists = seen(monkeypatch, metrics, "evaluate")
    train.cross_validate(prepared, "gbt", TINY, 2)
    assert len(hists) == 1 and hists[0].inputFiles()


def test_held_out_rows_are_scored_once_per_trial(prepared, monkeypatch):
    hists = seen(monkeypatch, metrics, "ranking_metrics")
    rows = train.with_folds(prepared, "gbt", 2)
    try:
        assert 0 <= search.held_out_auc(rows, "gbt", TINY, 2) <= 1
    finally:
        rows.unpersist()
    assert len(hists) == 1 and hists[0].inputFiles()


@pytest.mark.parametrize("profile", ["gbt", "gbt_coded"])
def test_marked_rows_train_as_two_tables_do(prepared, monkeypatch, profile):
    encoded = seen(monkeypatch, train, "encode_rows")
    model, found = train.train_and_evaluate(prepared, profile, TINY)
    assert "Union" not in encoded[0]._jdf.queryExecution().optimizedPlan().toString()
    rows = train.labelled(prepared).withColumn("split", train.split_column())
    parts = [rows.filter(f"split = '{s}'").drop("split") for s in ("train", "test")]
    apart = train.fit(parts[0], profile, TINY, parts[1])
    assert model.trees.toDebugString.split("\n")[1:] == apart.trees.toDebugString.split("\n")[1:]
    assert sorted(r["split"] for r in found.collect()) == ["test", "train"]


@pytest.mark.parametrize("rows, most", [(10, 4), (60, 2), (1000, 2)])
def test_large_fits_take_turns(monkeypatch, rows, most):
    monkeypatch.setattr(train, "FIT_ROWS", 100)
    turns, lock, running, peak = train._Turns(), threading.Lock(), [0], [0]

    def fit():
        with turns.of(rows):
            with lock:
                running[0] += 1
                peak[0] = max(peak[0], running[0])
            time.sleep(0.2)
            with lock:
                running[0] -= 1

    threads = [threading.Thread(target=fit) for _ in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join(20)
    assert not any(t.is_alive() for t in threads) and peak[0] == most


def test_scores_read_the_written_prepared_loans(spark, sf_dir):
    files = all_queries.QUERIES["score_loans"](spark, sf_dir).inputFiles()
    assert files and all("/prepared-" in f for f in files)


def test_preparation_is_learned_once_per_folder(spark, sf_dir):
    whole, requests = preparation.fitted(spark, sf_dir), preparation.fitted(spark, sf_dir, include_target=False)
    assert requests.groups is whole.groups and whole.include_target and not requests.include_target
