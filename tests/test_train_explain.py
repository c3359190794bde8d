import itertools

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lendframe.operators import explain, score, search, split, train
from lendframe.operators.prepare import PreparationEstimator
from lendframe.sources.registry import ModelRegistry

PARAMS = {"n_estimators": 4, "max_depth": 3, "min_child_samples": 5, "min_split_gain": 0.0, "subsample": 1.0, "colsample_bytree": 1.0}
CODED = {k: v for k, v in PARAMS.items() if k != "min_child_samples" and k != "min_split_gain"}


@pytest.fixture(scope="module")
def prepared(raw):
    return PreparationEstimator(2025).fit(raw).transform(raw).cache()


@pytest.fixture(scope="module")
def model(prepared):
    return train.fit(train.labelled(prepared), "gbt", PARAMS)


@pytest.fixture(scope="module")
def explained(model, prepared):
    return explain.explain(model, prepared).cache()


def test_scores_are_complete_and_consistent(model, prepared):
    rows = score.score(model, prepared, 0.4, "v7").collect()
    assert len(rows) == 1000
    for r in rows:
        assert 0 <= r["p_repaid"] <= 1
        assert r["prediction"] == int(r["p_repaid"] >= 0.4)
        assert r["p_repaid"] + r["p_default"] == pytest.approx(1)
        assert r["confidence"] == max(r["p_repaid"], r["p_default"])
        assert r["default_risk"] == ("Low" if r["prediction"] == 1 else "High")
        d = r["p_default"]
        assert r["risk_level"] == ("Low" if d < 0.2 else "Medium" if d < 0.5 else "High")
        assert r["model_version"] == "v7"
    assert {r["prediction"] for r in score.score(model, prepared, 0.0).collect()} == {1}


def test_importances_sum_to_one(model):
    pairs = model.importance()
    assert len(pairs) == 19 and sum(v for _, v in pairs) == pytest.approx(1.0)
    assert [v for _, v in pairs] == sorted((v for _, v in pairs), reverse=True)


@pytest.mark.parametrize("profile,params", [("gbt", PARAMS), ("gbt_coded", CODED), ("forest", {"n_estimators": 3, "max_depth": 3})])
def test_save_and_load_give_equal_scores(spark, prepared, tmp_path, profile, params):
    fitted = train.fit(train.labelled(prepared), profile, params)
    fitted.save(f"{tmp_path}/m")
    again = train.LoanModel.load(f"{tmp_path}/m", profile)
    a, b = score.score(fitted, prepared), score.score(again, prepared)
    assert a.exceptAll(b).isEmpty() and a.count() == b.count() == 1000


def test_unseen_categories_and_missing_features(model, prepared):
    odd = prepared.limit(5).withColumn("purpose", F.lit("boat"))
    assert score.score(model, odd).count() == 5
    with pytest.raises(ValueError, match="dti"):
        model.transform(prepared.drop("dti"))
    with pytest.raises(ValueError, match="unknown parameters"):
        train.estimator("gbt", {"num_leaves": 3})


def test_training_stops_early_on_validation_rows(prepared):
    rows = train.labelled(prepared)
    held = rows.filter(split.split_column() == "test")
    known = rows.filter(split.split_column() == "train")
    params = {**PARAMS, "n_estimators": 40}
    stopped = train.fit(known, "gbt", params, held, patience=3).trees
    assert 1 <= stopped.getNumTrees < 40
    # The same trees as those of a run without a stop, cut where its validation loss allows.
    part = train.fit(known, "gbt", {**params, "n_estimators": stopped.getNumTrees}, None).trees
    assert part.toDebugString.split("\n", 1)[1] == stopped.toDebugString.split("\n", 1)[1]
    whole = train.fit(known, "gbt", {**params, "n_estimators": 6}, held.limit(0)).trees
    assert whole.getNumTrees == 6


def test_a_dip_shorter_than_the_patience_does_not_stop():
    losses = [5.0, 4.0, 4.5, 4.2, 3.0, 3.1, 3.2, 3.3, 2.0]
    assert train.best_rounds(losses, 2) == (2, True)
    assert train.best_rounds(losses, 3) == (5, True)
    assert train.best_rounds(losses, 4) == (9, False)
    assert train.best_rounds([1.0], 1) == (1, False)


def test_class_weight(prepared):
    rows = train.labelled(prepared)
    row = split.class_weights(rows).first()
    got = split.with_class_weight(rows).groupBy("label").agg(F.min("weight"), F.max("weight")).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == {0.0: (1.0, 1.0), 1.0: (row["neg"] / row["pos"],) * 2}


def test_cross_validation_and_search(prepared):
    folds = train.cross_validate(prepared, "gbt", {**PARAMS, "n_estimators": 2}, 3)
    assert {r["fold"] for r in folds.collect()} == {0, 1, 2}
    for r in train.cv_summary(folds).collect():
        assert r["lowest"] <= r["mean"] <= r["highest"] and r["std"] >= 0
    space = {"n_estimators": {"type": "int", "low": 1, "high": 2}, "max_depth": {"type": "categorical", "choices": [2, 3]}}
    found = search.Search("gbt", space, folds=2)
    best = found.tune(prepared, 3, "halving", shares=(0.5, 1.0))
    rows = found.history(prepared).collect()
    last = [r for r in rows if r["rung"] == 1]
    assert len([r for r in rows if r["rung"] == 0]) == 3 and len(last) == 2
    assert found.best_value == max(r["value"] for r in last)
    assert [r["best"] for r in rows].count(True) == 1
    assert search.draw(space, 5, 1) == search.draw(space, 5, 1) != search.draw(space, 5, 2)
    assert found.best_model(prepared).profile == "gbt" and best == found.best_params


def test_contributions_add_up_to_the_margin(explained, model):
    total = F.aggregate("contributions", F.col("base"), lambda a, c: a + c)
    gap = explained.agg(F.max(F.abs(total - F.col("margin")))).first()[0]
    assert gap < 1e-9
    odds = F.abs(F.lit(1.0) / (1 + F.exp(-2 * F.col("margin"))) - F.col("probability"))
    assert explained.agg(F.max(odds)).first()[0] < 1e-9


def test_contributions_equal_shapley_values_by_enumeration(spark, model, prepared):
    """Shapley values of the path-dependent expectation, summed over all feature subsets."""
    x = np.array(model.transform(prepared.orderBy("loan_id").limit(3)).select(vector_to_array("features")).first()[0])
    trees, base = explain.packed_trees(spark, model)
    want, empty = enumerated(trees, x, 19)
    assert np.allclose(explain.contributions(x[None, :], trees, 19)[0], want, atol=1e-10)
    assert base == pytest.approx(empty, abs=1e-10)


def enumerated(trees, x, width):
    """(Shapley values by all subsets of each tree's features, value of the empty subset)."""

    def expect(tree, i, known):
        if tree.feature[i] < 0:
            return tree.value[i]
        a, b = int(tree.left[i]), int(tree.right[i])
        if tree.feature[i] in known:
            return expect(tree, a if tree.goes_left(i, x[None, :])[0] else b, known)
        return tree.share[a] * expect(tree, a, known) + tree.share[b] * expect(tree, b, known)

    want, empty = np.zeros(width), 0.0
    for tree in trees:
        mine = sorted({int(f) for f in tree.feature if f >= 0})
        m = len(mine)
        empty += expect(tree, 0, set())
        for i in mine:
            rest = [j for j in mine if j != i]
            for k in range(m):
                share = 1 / (m * len(list(itertools.combinations(rest, k))))
                for known in itertools.combinations(rest, k):
                    want[i] += share * (expect(tree, 0, {*known, i}) - expect(tree, 0, set(known)))
    return want, empty


def test_contributions_of_random_trees_with_repeated_features():
    """Features that come back on a path, categories, and children few rows reached."""
    source = np.random.default_rng(4)
    for _ in range(8):
        feature, left, right, value, share, cut, codes = [], [], [], [], [], [], []

        def put(depth, part):
            at = len(feature)
            inner = depth < 6 and source.random() < 0.85
            f = int(source.integers(0, 4)) if inner else -1
            feature.append(f), left.append(0), right.append(0), value.append(source.normal()), share.append(part)
            cut.append(source.normal())
            codes.append(np.array([0.0, 2.0]) if f == 3 else None)
            if inner:
                q = float(source.choice([0.001, 0.3, 0.8]))
                left[at] = put(depth + 1, q)
                right[at] = put(depth + 1, 1 - q)
            return at

        put(0, 1.0)
        tree = explain.PackedTree(*map(np.array, (feature, left, right, value, share, cut)), codes)
        x = np.column_stack([source.normal(size=(5, 3)), source.integers(0, 4, 5)])
        got = explain.contributions(x, [tree], 4)
        for row, mine in zip(x, got):
            assert np.allclose(mine, enumerated([tree], row, 4)[0], atol=1e-10)
        assert tree.base() == pytest.approx(enumerated([tree], x[0], 4)[1])


def test_reasons_waterfall_importance_and_dependence(explained, model, tmp_path):
    names = model.features
    reasons = explain.top_reasons(explained, names).filter("loan_id = 3").orderBy("rank").collect()
    sizes = [abs(r["contribution"]) for r in reasons]
    assert [r["rank"] for r in reasons] == [1, 2, 3, 4, 5] and sizes == sorted(sizes, reverse=True)
    for r in reasons:
        assert r["direction"] == ("positive" if r["contribution"] > 0 else "negative" if r["contribution"] < 0 else None)
    steps = explain.waterfall(explained, names).filter("loan_id = 3").orderBy("rank").collect()
    margin = explained.filter("loan_id = 3").first()["margin"]
    assert len(steps) == 19 and steps[-1]["running"] == pytest.approx(margin, abs=1e-9)
    importance = explain.global_importance(explained, names).collect()
    long = explain.long_contributions(explained, names)
    want = {r[0]: r[1] for r in long.groupBy("feature").agg(F.avg(F.abs("contribution"))).collect()}
    assert all(r["importance"] == pytest.approx(want[r["feature"]]) for r in importance)
    assert explain.dependence(explained, names, "dti", "int_rate").count() == 1000
    explain.save_contributions(explained, f"{tmp_path}/c")
    assert explain.load_contributions(explained.sparkSession, f"{tmp_path}/c").exceptAll(explained).isEmpty()


def test_registry_stages_loading_and_runs(spark, model, prepared, tmp_path):
    registry = ModelRegistry(spark, f"file:{tmp_path}/registry")
    assert registry.models().isEmpty()
    for v, stage, auc in (("v1", "staging", 0.6), ("v2", "staging", 0.7), ("v3", "development", 0.8)):
        registry.register(model, "m", v, {"auc": auc}, PARAMS, {"by": "test"}, stage)
    registry.promote("m", "v1", "production")
    registry.promote("m", "v2", "production")
    assert {r["version"]: r["stage"] for r in registry.versions("m").collect()} == {"v1": "archived", "v2": "production", "v3": "development"}
    registry.promote("m", "v2", "production")
    registry.promote("m", "v3", "staging")
    assert {r["version"]: r["stage"] for r in registry.versions("m").collect()} == {"v1": "archived", "v2": "production", "v3": "staging"}
    listed = registry.models().first()
    assert (listed["versions_count"], listed["production_version"], listed["staging_version"]) == (3, "v2", "v3")
    assert [r["auc"] for r in registry.compare("m", ["v1", "v3"], ["auc"]).orderBy("version").collect()] == [0.6, 0.8]
    assert registry.metadata("m").first()["version"] == "v3"
    assert registry.metadata("m", "v1").first()["tags"] == {"by": "test"}
    a = score.score(registry.load("m", stage="production"), prepared)
    assert a.exceptAll(score.score(model, prepared)).isEmpty()
    registry.log_run("r1", model, {"auc": 0.6}, PARAMS)
    assert {r["kind"] for r in registry.runs().collect()} == {"parameter", "metric", "importance"}
    for wrong in (
        lambda: registry.promote("m", "v9", "staging"),
        lambda: registry.promote("x", "v1", "staging"),
        lambda: registry.promote("m", "v1", "live"),
        lambda: registry.register(model, "m", "v4", stage="live"),
        lambda: registry.load("m", "v9"),
        lambda: registry.load("m", stage="archived"),
        lambda: registry.load("x"),
    ):
        with pytest.raises(ValueError):
            wrong()


def test_patterns_of_sides_give_what_the_walk_gives(monkeypatch):
    source = np.random.default_rng(5)
    n = 31
    inner = np.arange(n) < 15
    left, right = (np.where(inner, 2 * np.arange(n) + k, 0) for k in (1, 2))
    feature = np.where(inner, source.integers(0, 4, n), -1)
    share = np.ones(n)
    share[1::2] = source.uniform(0.1, 0.9, n // 2)
    share[2::2] = 1 - share[1::2]
    codes = [np.flatnonzero(source.random(9) < 0.5) if i % 2 else None for i in range(n)]
    made = lambda: explain.PackedTree(feature, left, right, source.normal(size=n), share, source.uniform(0, 8, n), codes)
    trees = [made(), made()]
    x = source.integers(0, 10, (500, 4)).astype(float)
    found = explain.contributions(x, trees, 4)
    assert all(len(t.groups()) > 1 for t in trees)
    walked = np.zeros((500, 4))
    for tree in trees:
        explain._walked(tree, len(x), lambda i, tree=tree: tree.goes_left(i, x), walked)
        for i in np.flatnonzero(inner & (np.arange(n) % 2 == 1)):
            assert np.array_equal(tree.goes_left(i, x), np.isin(x[:, feature[i]], codes[i]))
    assert np.allclose(found, walked, atol=1e-12)
    monkeypatch.setattr(explain, "PATTERN_BITS", 2)
    assert np.allclose(explain.contributions(x, [explain.PackedTree(*(getattr(t, f) for f in (
        "feature", "left", "right", "value", "share", "cut", "codes"))) for t in trees], 4), walked, atol=1e-12)
