"""Additive explanations of tree-ensemble scores.

For every row and feature the exact path-dependent contribution (Lundberg et al., TreeSHAP) to the model margin is
computed. With the polynomial P(t) = prod_j (t o_j + (1 - t) z_j) of a leaf with value v, where o_j says whether the row
meets all conditions of feature j on the path and z_j is the share of training rows that do, feature i gets

    v (o_i - z_i) * integral over t in [0, 1] of P(t) / (t o_i + (1 - t) z_i)

The integrand has degree m - 1 for m features on the path, so Gauss-Legendre quadrature with ceil(m / 2) points is
exact. One walk over a tree carries P at these points down, for a whole batch of rows at once, and brings the sums of v P
over the leaves below back up; every edge then adds its share. So work grows with nodes, not with leaves times depth.

A tree is cut into subtrees that, with the path to them, have at most `PATTERN_BITS` inner nodes. What their leaves contribute
depends only on which side a row takes at these nodes, so the walk is done once per pattern of sides, and a row looks its
pattern up. A tree with a longer path is walked with the rows themselves.

Rows stay in their partitions. Trees are packed into arrays by tasks, one tree each; a pack is sent to every worker once.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendframe.operators.leafwise import LeafwiseModel
from lendframe.operators.train import LoanModel
from lendframe.schema import ID
from lendframe.session import work_path

CHUNK_ROWS = 4_096
PATTERN_BITS = 9
_LEAST_SHARE = 1e-12  # stands for a child no training row reached


def _by_code(codes: Sequence[float]) -> np.ndarray:
    """Whether each code is listed, up to the one after the last."""
    places = np.array(codes, np.int64)
    out = np.zeros(int(places.max(initial=-1)) + 2, bool)
    out[places] = True
    return out


@dataclass
class _Group:
    """Contributions of a subtree's leaves by pattern: bit k says whether a row goes left at `nodes[k]`."""

    nodes: list[int]
    features: list[int]
    table: np.ndarray  # (features, patterns)


@dataclass
class PackedTree:
    """Node arrays, root first; children come after their parents, a leaf has feature -1."""

    feature: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    share: np.ndarray  # of the parent's training rows
    cut: np.ndarray  # of a number: values up to it go left
    codes: list[np.ndarray | None]  # of a category: the codes that go left

    def __post_init__(self) -> None:
        self._listed = [None if c is None else _by_code(c) for c in self.codes]
        self._groups: list[_Group] | None = None

    def goes_left(self, node: int, x: np.ndarray) -> np.ndarray:
        v = x[:, self.feature[node]]
        listed = self._listed[node]
        return v <= self.cut[node] if listed is None else listed.take(v.astype(np.int64), mode="clip")

    def groups(self) -> "list[_Group]":
        """The subtrees with their patterns, made on first use; none where a path is too long."""
        if self._groups is None:
            self._groups = _grouped(self)
        return self._groups

    def points(self) -> tuple[np.ndarray, np.ndarray]:
        """Quadrature points and weights on [0, 1] for the most features any path has."""
        most, waiting = 1, [(0, frozenset())]
        while waiting:
            i, seen = waiting.pop()
            if self.feature[i] < 0:
                most = max(most, len(seen))
            else:
                waiting += [(c, seen | {self.feature[i]}) for c in (self.left[i], self.right[i])]
        t, w = np.polynomial.legendre.leggauss((most + 1) // 2)
        return (t + 1) / 2, w / 2

    def depth(self) -> int:
        """Inner nodes on the longest path."""
        level = np.zeros(len(self.feature), int)
        for i in np.flatnonzero(self.feature >= 0):
            level[[self.left[i], self.right[i]]] = level[i] + 1
        return int(level.max())

    def base(self) -> float:
        """The mean over training rows."""
        reach = np.ones(len(self.feature))
        for i in np.flatnonzero(self.feature >= 0):
            for c in (self.left[i], self.right[i]):
                reach[c] = reach[i] * self.share[c]
        return float((reach * self.value)[self.feature < 0].sum())


def add_contributions(tree: PackedTree, x: np.ndarray, out: np.ndarray) -> None:
    """Add the contributions of one tree to `out` (rows, features)."""
    sides: dict[int, np.ndarray] = {}
    for group in tree.groups():
        pattern = np.zeros(len(x), np.uint16)
        for k, i in enumerate(group.nodes):
            if i not in sides:
                sides[i] = tree.goes_left(i, x).astype(np.uint16)
            pattern |= sides[i] << np.uint16(k)
        for f, values in zip(group.features, group.table):
            out[:, f] += values.take(pattern)
    if not tree.groups():
        _walked(tree, len(x), lambda i: tree.goes_left(i, x), out)


def _grouped(tree: PackedTree) -> list[_Group]:
    found: list[_Group] = []

    def inner(i: int) -> list[int]:
        return [] if tree.feature[i] < 0 else [i, *inner(int(tree.left[i])), *inner(int(tree.right[i]))]

    def cut(i: int, path: dict[int, int]) -> bool:
        """Whether all leaves below are in groups."""
        below = inner(i)
        if len(path) + len(below) > PATTERN_BITS:
            return bool(below) and all(cut(int(c), {**path, i: int(c)}) for c in (tree.left[i], tree.right[i]))
        nodes = [*path, *below]
        patterns = np.arange(1 << len(nodes))
        bit = {i: (patterns >> k & 1).astype(bool) for k, i in enumerate(nodes)}
        out = np.zeros((len(patterns), int(tree.feature.max()) + 1))
        _walked(tree, len(patterns), bit.__getitem__, out, path)
        features = sorted({int(tree.feature[i]) for i in nodes})
        found.append(_Group(nodes, features, np.ascontiguousarray(out[:, features].T)))
        return True

    # A path is as deep as the tree, which may be too deep to recurse when it is not grouped anyway.
    return found if tree.depth() <= PATTERN_BITS and cut(0, {}) else []


def _walked(
    tree: PackedTree, n: int, goes_left: Callable[[int], np.ndarray], out: np.ndarray, path: Mapping[int, int] | None = None
) -> None:
    """Add the contributions of the leaves below `path`, which names the child to enter at its nodes, for n rows."""
    t, w = tree.points()
    everyone = np.ones(n, bool)
    path = path or {}

    def factors(z: float) -> np.ndarray:
        """t o + (1 - t) z at every point, for o = 0 and 1."""
        return np.stack([(1 - t) * z, t + (1 - t) * z])

    def walk(i: int, p: np.ndarray, met: dict[int, tuple[np.ndarray, float]]) -> np.ndarray:
        if tree.feature[i] < 0:
            return tree.value[i] * p
        f = int(tree.feature[i])
        known = f in met
        o_old, z_old = met.get(f, (everyone, 1.0))
        old = factors(z_old) if known else np.ones((2, len(t)))
        left = goes_left(i)
        total: np.ndarray | float = 0.0
        for c, side in ((int(tree.left[i]), left), (int(tree.right[i]), ~left)):
            if path.get(i, c) != c:
                continue
            o, z = o_old & side, z_old * max(float(tree.share[c]), _LEAST_SHARE)
            new = factors(z)
            # Rows that met the conditions so far and still do, no longer do, or never did.
            ratio = np.stack([new[0] / old[0], new[0] / old[1], new[1] / old[1]])
            below = walk(c, p * ratio[o_old.astype(np.int8) + o], {**met, f: (o, z)})
            sums = below @ np.concatenate([w / new, w / old]).T
            gain = np.where(o, (1 - z) * sums[:, 1], -z * sums[:, 0])
            if known:
                # The edge above adds its own share for these leaves, which now have a deeper condition.
                gain -= np.where(o_old, (1 - z_old) * sums[:, 3], -z_old * sums[:, 2])
            out[:, f] += gain
            total = total + below
        return total

    walk(0, np.ones((n, len(t))), {})


def contributions(x: np.ndarray, trees: list[PackedTree], width: int) -> np.ndarray:
    """(rows, features) contributions for a batch of feature vectors."""
    out = np.zeros((len(x), width))
    for start in range(0, len(x), CHUNK_ROWS):
        # A feature's values, and its contributions, in one piece.
        own = np.asfortranarray(x[start : start + CHUNK_ROWS])
        total = np.zeros(own.shape[:1] + (width,), order="F")
        for tree in trees:
            add_contributions(tree, own, total)
        out[start : start + CHUNK_ROWS] = total
    return out


def _pack(rows: pd.DataFrame, weight: float = 1.0) -> PackedTree:
    """Node rows of one tree (id, feature, left, right, value, cover, cut, codes) as arrays, in order of id."""
    rows = rows.sort_values("id")
    place = {i: k for k, i in enumerate(rows["id"])}
    feature = rows["feature"].to_numpy(np.int64)
    cover = rows["cover"].to_numpy(float)
    left, right = (np.array([place.get(i, 0) for i in rows[s]], np.int64) for s in ("left", "right"))
    share = np.ones(len(rows))
    for i in np.flatnonzero(feature >= 0):
        for c in (left[i], right[i]):
            share[c] = cover[c] / cover[i] if cover[i] else 0.5
    codes = [None if c is None else np.array(c, float) for c in rows["codes"]]
    return PackedTree(feature, left, right, weight * rows["value"].to_numpy(float), share, rows["cut"].to_numpy(float), codes)


def _node_table(spark: SparkSession, model: LoanModel) -> DataFrame:
    """The nodes of a Spark ML ensemble as a table; its files are written once per model."""
    path = getattr(model, "_node_path", None)
    if path is None:
        path = work_path(spark, "trees")
        model.trees.write().overwrite().save(path)
        model._node_path = path
    split = "nodeData.split"
    test = F.col(f"{split}.leftCategoriesOrThreshold")
    category = F.col(f"{split}.numCategories") > 0
    inner = F.col("nodeData.leftChild") >= 0
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"),
        F.col("nodeData.id").alias("id"),
        F.when(inner, F.col(f"{split}.featureIndex")).otherwise(-1).alias("feature"),
        F.col("nodeData.leftChild").alias("left"),
        F.col("nodeData.rightChild").alias("right"),
        F.col("nodeData.prediction").alias("value"),
        F.col("nodeData.rawCount").cast("double").alias("cover"),
        F.when(inner & ~category, test[0]).otherwise(0.0).alias("cut"),
        F.when(inner & category, test).alias("codes"),
    )


def packed_trees(spark: SparkSession, model: LoanModel | LeafwiseModel) -> tuple[list[PackedTree], float]:
    """(trees as arrays, base value): the margin's expectation and what moves it."""
    if isinstance(model, LeafwiseModel):
        columns = ["tree", "id", "feature", "left", "right", "value", "cover", "codes"]
        rows = pd.DataFrame(list(model.node_rows()), columns=columns).assign(cut=0.0)
        trees = [_pack(g) for _, g in rows.groupby("tree")]
        return trees, model.start + sum(t.base() for t in trees)
    weights = list(model.trees.treeWeights)

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        tree = int(rows["tree"].iloc[0])
        return pd.DataFrame({"tree": [tree], "data": [pickle.dumps(_pack(rows, weights[tree]))]})

    packs = _node_table(spark, model).groupBy("tree").applyInPandas(one, "tree int, data binary")
    # As large as the model, which every worker needs; nodes reach the driver as packed arrays only.
    trees = [pickle.loads(bytes(r.data)) for r in sorted(packs.collect(), key=lambda r: r.tree)]
    return trees, sum(t.base() for t in trees)


def explain(model: LoanModel | LeafwiseModel, prepared: DataFrame) -> DataFrame:
    """(loan_id, base, margin, probability, values, contributions): one row per loan, arrays in feature order.

    Contributions add up to margin - base. The margin of Spark's boosted trees is half the log-odds, that of
    leaf-wise trees is the log-odds. `values` are the feature values the trees see. Boosted trees only.
    """
    if model.profile == "forest":
        raise ValueError("contributions are defined on the margin of boosted trees")
    spark = prepared.sparkSession
    trees, base = packed_trees(spark, model)
    width = len(model.features)
    shared = spark.sparkContext.broadcast(trees)
    scored = model.transform(prepared)
    if isinstance(model, LeafwiseModel):
        binning = model.binning

        @F.pandas_udf("array<double>")
        def codes(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            for columns in batches:
                yield pd.Series(list(binning.codes(*columns).astype(float)))

        inputs = codes(*binning.inputs())
    else:
        inputs = vector_to_array("features")

    @F.pandas_udf("array<double>")
    def explained(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            x = np.stack(batch.to_numpy()) if len(batch) else np.zeros((0, width))
            yield pd.Series(list(contributions(x, shared.value, width)))

    return scored.select(
        ID,
        F.lit(base).alias("base"),
        vector_to_array("rawPrediction")[1].alias("margin"),
        vector_to_array("probability")[1].alias("probability"),
        inputs.alias("values"),
    ).withColumn("contributions", explained("values"))


def _named(names: list[str]) -> Column:
    """Array of (feature, contribution), largest absolute value first, then by name."""
    listed = F.array(*[F.lit(n) for n in names])
    pairs = F.arrays_zip(listed.alias("feature"), F.col("contributions").alias("contribution"))
    keyed = F.transform(
        pairs,
        lambda p: F.struct(
            (-F.abs(p["contribution"])).alias("k"),
            p["feature"].alias("feature"),
            p["contribution"].alias("contribution"),
        ),
    )
    return F.array_sort(keyed)


def long_contributions(explained: DataFrame, names: list[str]) -> DataFrame:
    """(loan_id, feature, value, contribution): one row per loan and feature."""
    listed = F.array(*[F.lit(n) for n in names])
    rows = explained.select(
        ID,
        F.explode(
            F.arrays_zip(
                listed.alias("feature"),
                F.col("values").alias("value"),
                F.col("contributions").alias("contribution"),
            )
        ).alias("r"),
    )
    return rows.select(ID, "r.feature", "r.value", "r.contribution")


def global_importance(explained: DataFrame, names: list[str]) -> DataFrame:
    """(feature, importance): mean absolute contribution, largest first; one aggregate, no explode."""
    packed = [
        F.struct(
            F.lit(n).alias("feature"), F.avg(F.abs(F.col("contributions")[i])).alias("importance")
        )
        for i, n in enumerate(names)
    ]
    rows = explained.agg(F.array(*packed).alias("r")).select(F.explode("r").alias("r")).select("r.*")
    return rows.orderBy(F.desc("importance"), "feature")


def top_reasons(explained: DataFrame, names: list[str], k: int = 5) -> DataFrame:
    """(loan_id, rank, feature, contribution, direction): the k strongest reasons of every loan."""
    best = F.slice(_named(names), 1, k)
    rows = explained.select(ID, F.posexplode(best).alias("i", "r"))
    up = F.when(F.col("r.contribution") > 0, "positive").when(F.col("r.contribution") < 0, "negative")
    return rows.select(
        ID, (F.col("i") + 1).alias("rank"), "r.feature", "r.contribution", up.alias("direction")
    )


def waterfall(explained: DataFrame, names: list[str]) -> DataFrame:
    """(loan_id, rank, feature, contribution, running): running total from the base to the margin."""
    ordered = explained.select(ID, "base", _named(names).alias("r"))
    totals = F.aggregate(
        "r",
        F.array(F.col("base")),
        lambda acc, r: F.concat(acc, F.array(F.element_at(acc, -1) + r["contribution"])),
    )
    with_totals = ordered.withColumn("t", totals)
    rows = with_totals.select(ID, "t", F.posexplode("r").alias("i", "r"))
    return rows.select(
        ID,
        (F.col("i") + 1).alias("rank"),
        "r.feature",
        "r.contribution",
        F.col("t")[F.col("i") + 1].alias("running"),
    )


def dependence(explained: DataFrame, names: list[str], feature: str, interaction: str) -> DataFrame:
    """(loan_id, value, contribution, interaction_value) of one feature, coloured by another."""
    i, j = names.index(feature), names.index(interaction)
    return explained.select(
        ID,
        F.col("values")[i].alias("value"),
        F.col("contributions")[i].alias("contribution"),
        F.col("values")[j].alias("interaction_value"),
    )


def save_contributions(explained: DataFrame, path: str) -> None:
    explained.write.mode("overwrite").parquet(path)


def load_contributions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
