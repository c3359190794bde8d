"""Leaf-wise boosting against plain Python on the same bins."""

import threading
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lendframe.operators import explain, leafwise, score
from lendframe.operators.leafwise import CATEGORY_SMOOTHING, MIN_HESSIAN
from lendframe.plans import modelling
from lendframe.session import arrow_rows

TEXTS, NUMBERS = ["shade", "place"], ["a", "b", "c"]
PARAMS = {"n_estimators": 3, "num_leaves": 9, "max_depth": 6, "min_child_samples": 7, "subsample": 1.0, "colsample_bytree": 1.0}


@pytest.fixture(scope="module")
def rows(spark):
    source = np.random.default_rng(11)
    n = 900
    frame = pd.DataFrame(
        {
            "loan_id": np.arange(n),
            "shade": source.choice(["red", "green", "blue", "grey", None], n),
            "place": source.choice(list("uvwxyz"), n),
            "a": np.where(source.random(n) < 0.1, np.nan, source.normal(size=n)),
            "b": source.integers(0, 5, n).astype(float),
            "c": source.exponential(size=n),
        }
    )
    odds = (frame.shade == "red") * 1.5 + np.nan_to_num(frame.a) * frame.b / 2 - (frame.place.isin(["u", "z"]) & (frame.c > 1)) * 2
    frame["label"] = (source.random(n) < 1 / (1 + np.exp(-odds))).astype(float)
    layout = "loan_id long, shade string, place string, a double, b double, c double, label double"
    return spark.createDataFrame(frame.replace({np.nan: None}), layout).repartition(5).cache()


def train(rows, params=None, **more):
    return leafwise.train_leafwise(rows, {**PARAMS, **(params or {})}, texts=TEXTS, numbers=NUMBERS, **more)


def slow_tree(bins, g, h, categories, leaves, depth, least, min_gain, alpha, lam):
    """One leaf at a time, every feature and cut tried by counting the rows again: list of (rows that go left, gain)."""
    unit = 1 << 24
    cut = lambda s: max(abs(s) - alpha, 0.0) ** 2
    strength = lambda part: cut(g[part].sum() / unit) / (h[part].sum() / unit + lam + 1e-12)

    def best(rows, level):
        found = None
        if level >= depth or len(rows) < 2 * least:
            return None
        for j in range(bins.shape[1]):
            values = sorted(set(bins[rows, j].tolist()))
            if j < categories:
                ratio = {v: g[rows[bins[rows, j] == v]].sum() / unit / (h[rows[bins[rows, j] == v]].sum() / unit + CATEGORY_SMOOTHING) for v in values}
                values.sort(key=lambda v: (ratio[v], v))
            for k in range(1, len(values)):
                left = np.isin(bins[rows, j], values[:k])
                if left.sum() < least or (~left).sum() < least or min(h[rows[left]].sum(), h[rows[~left]].sum()) < MIN_HESSIAN * unit:
                    continue
                gain = strength(rows[left]) + strength(rows[~left]) - strength(rows)
                if gain > max(min_gain, 1e-9) and (found is None or gain > found[0] + 1e-12):
                    found = (gain, rows[left], rows[~left])
        return found

    waiting = [(best(np.arange(len(g)), 0), 0, np.arange(len(g)))]
    splits = []
    while len(splits) < leaves - 1:
        waiting.sort(key=lambda w: -(w[0][0] if w[0] else -1))
        if not waiting[0][0]:
            break
        (gain, left, right), level, _ = waiting.pop(0)
        splits.append((gain, frozenset(left.tolist()), frozenset(right.tolist())))
        waiting += [(best(left, level + 1), level + 1, left), (best(right, level + 1), level + 1, right)]
    return splits, [w[2] for w in waiting]


@pytest.mark.parametrize("best_first", [True, False])
def test_trees_equal_trying_every_cut(rows, best_first):
    if best_first:
        params = {"min_split_gain": 0.05, "reg_alpha": 0.3, "reg_lambda": 0.8}
        model = train(rows, params)
        limits = dict(leaves=9, depth=6, least=7, min_gain=0.05, alpha=0.3, lam=0.8)
    else:
        params = {"n_estimators": 3, "max_depth": 3, "gamma": 0.2, "colsample_bytree": 1.0, "learning_rate": 0.07}
        model = leafwise.train_leafwise(rows, params, texts=TEXTS, numbers=NUMBERS, best_first=False)
        limits = dict(leaves=8, depth=3, least=1, min_gain=0.4, alpha=0.1, lam=0.0)
    data = rows.toPandas()
    y = data.label.to_numpy()
    heavier = (y == 0).sum() / (y == 1).sum()
    bins = model.binning.codes(*[data[c] for c in TEXTS + NUMBERS]).astype(int)
    margin = np.full(len(y), model.start)
    assert model.start == pytest.approx(0.0) and len(model.trees) == 3
    for tree in model.trees:
        weight, p = np.where(y == 1, heavier, 1.0) * (1 << 24), 1 / (1 + np.exp(-margin))
        g, h = np.rint(weight * (p - y)), np.rint(weight * p * (1 - p))
        splits, leaves = slow_tree(bins, g, h, 2, **limits)
        at = tree.leaves(bins)
        got = {frozenset(np.flatnonzero(at == i).tolist()) for i in set(at.tolist())}
        assert got == {frozenset(x.tolist()) for x in leaves}
        assert int((tree.left != np.arange(len(tree.left))).sum()) == len(splits)
        for i in set(at.tolist()):
            mine = at == i
            s, t = g[mine].sum() / (1 << 24), h[mine].sum() / (1 << 24)
            want = -0.07 * np.sign(s) * max(abs(s) - limits["alpha"], 0) / (t + limits["lam"])
            assert tree.value[i] == pytest.approx(want, abs=1e-9) and tree.cover[i] == mine.sum()
        margin = margin + tree.value[at]
    got = {r.loan_id: r.margin for r in model.transform(rows).select("loan_id", "margin").collect()}
    assert np.allclose([got[i] for i in data.loan_id], margin)


def test_the_same_trees_under_any_partitioning(rows):
    one, many = (train(rows.repartition(n), {"subsample": 0.7, "colsample_bytree": 0.6}) for n in (1, 7))
    assert list(one.node_rows()) == list(many.node_rows())
    plain = list(train(rows).node_rows())
    assert plain != list(one.node_rows())


def test_stopping_keeps_the_best_trees(rows, monkeypatch):
    monkeypatch.setattr(leafwise, "SNAPSHOT", 4)
    known, held = rows.where("loan_id % 3 > 0"), rows.where("loan_id % 3 = 0")
    model = train(known, {"n_estimators": 60, "learning_rate": 0.5}, validation=held, patience=5)
    best = int(np.argmin(model.losses))
    assert len(model.trees) == best and len(model.losses) == best + 6 <= 60
    weight = known.agg(F.count_if(F.col("label") == 0) / F.sum("label")).first()[0]
    scored = model.transform(held).select("label", "margin").collect()
    w = np.array([weight if r.label else 1.0 for r in scored])
    loss = np.array([np.logaddexp(0, -r.margin if r.label else r.margin) for r in scored])
    assert model.losses[best] == pytest.approx((w * loss).sum() / w.sum(), abs=1e-6)
    whole = train(known, {"n_estimators": best, "learning_rate": 0.5})
    assert list(whole.node_rows()) == list(model.node_rows())


def test_saved_models_score_and_explain_alike(spark, rows, tmp_path):
    model = train(rows)
    model.save(spark, f"file:{tmp_path}/m")
    again = leafwise.LeafwiseModel.load(spark, f"file:{tmp_path}/m")
    a, b = score.score(model, rows), score.score(again, rows)
    assert a.exceptAll(b).isEmpty() and a.count() == 900 and again.importance() == model.importance()
    explained = explain.explain(again, rows)
    total = F.aggregate("contributions", F.col("base"), lambda x, c: x + c)
    assert explained.agg(F.max(F.abs(total - F.col("margin")))).first()[0] < 1e-9
    odd = rows.limit(3).withColumns({"shade": F.lit("violet"), "a": F.lit(float("nan"))})
    assert score.score(again, odd).count() == 3
    with pytest.raises(ValueError, match="missing features"):
        again.transform(rows.drop("a"))
    with pytest.raises(ValueError, match="unknown parameters"):
        train(rows, {"trees": 3})
    with pytest.raises(ValueError, match="both classes"):
        train(rows.where("label = 1"))


def test_losses_and_routes_do_not_depend_on_how_rows_are_dealt(rows, monkeypatch):
    known, held = rows.where("loan_id % 3 > 0"), rows.where("loan_id % 3 = 0")
    one = train(known, validation=held)
    monkeypatch.setattr(leafwise, "_LEAST_ROWS", 64)
    monkeypatch.setattr(leafwise, "_TASK_ROWS", 100)
    monkeypatch.setattr(leafwise, "_COLLECTED", 0)
    many = train(known.repartition(9), validation=held.repartition(4))
    assert one.losses == many.losses and list(one.node_rows()) == list(many.node_rows())
    data = held.toPandas()
    bins = one.binning.codes(*[data[c] for c in TEXTS + NUMBERS])
    none = np.zeros(0)
    block = leafwise.Block(np.ascontiguousarray(bins.T), none, none, none, True)
    for tree in one.trees:
        at = tree.leaves(bins)
        wanted = (tree.left == np.arange(len(tree.left))) & (np.arange(len(tree.left)) % 2 == 0)
        got = {i: sorted(own.tolist()) for i, own in block.leaves(tree, np.arange(len(at)), wanted) if len(own)}
        assert got == {i: np.flatnonzero(at == i).tolist() for i in set(at.tolist()) if wanted[i]}


def test_snapshots_leave_the_number_of_tasks_alone(spark, monkeypatch):
    """Each snapshot read back in more partitions than it was written from, so passes got slower and slower."""
    numbers = [F.rand(k).alias(c) for k, c in enumerate(NUMBERS)]
    rows = spark.range(30_000, numPartitions=3).select(*numbers).withColumn("label", (F.col("a") > F.col("b")).cast("double"))
    grow = lambda: leafwise.train_leafwise(rows, {**PARAMS, "n_estimators": 4}, texts=[], numbers=NUMBERS)
    plain, parts, real = grow(), [], leafwise._summed
    monkeypatch.setattr(leafwise, "SNAPSHOT", 1)

    def spy(blocks, work):
        found = real(blocks, work)
        parts.append((blocks.getNumPartitions(), work.routing is None and blocks.isCheckpointed()))
        return found

    monkeypatch.setattr(leafwise, "_summed", spy)
    often = grow()
    assert list(often.node_rows()) == list(plain.node_rows())
    assert len({n for n, _ in parts}) == 1
    assert sum(written for _, written in parts) == 3


def test_both_profiles_train_at_the_same_time(spark, monkeypatch):
    together = threading.Barrier(2, timeout=20)

    def boosted(session, folder, best_first):
        together.wait()
        losses = [0.7 - k / 1000 for k in range(modelling.LEAFWISE["n_estimators"] + 1 if best_first else 10)]
        losses += [] if best_first else [0.9] * modelling.STOP_AFTER
        kept = [None] * losses.index(min(losses))
        found = ({"split": s} for s in ("train", "validation", "test"))
        return SimpleNamespace(losses=losses, trees=kept, profile="leafwise" if best_first else "depthwise"), tuple(found)

    monkeypatch.setattr(modelling, "_boosted", boosted)
    monkeypatch.setattr(modelling, "stored", lambda session, folder: None)
    rows = [tuple(r) for r in modelling.booster_invariants(spark, "none").collect()]
    assert rows == [("leafwise", True, True, True, True), ("depthwise", True, True, True, True)]


def test_rows_handed_to_python_are_set_by_one_thread_at_a_time(spark):
    name, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    before, inside, begun = spark.conf.get(name), threading.Event(), threading.Event()

    def other():
        begun.set()
        with arrow_rows(spark, 7):
            inside.set()
            seen.append(spark.conf.get(name))

    thread = threading.Thread(target=other)
    with arrow_rows(spark, 5):
        thread.start()
        begun.wait(10)
        assert not inside.wait(0.5) and spark.conf.get(name) == "5"
    thread.join(20)
    assert seen == ["7"] and spark.conf.get(name) == before
