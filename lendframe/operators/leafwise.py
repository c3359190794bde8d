"""Gradient-boosted trees that grow leaf by leaf, from histograms that Spark adds up.

Rows become blocks of bin numbers, a row of numbers per feature. A pass over the blocks routes rows to the counted leaves and
adds, per open node, feature and bin, count, gradient and hessian; tasks hand over one histogram per node, which are
summed per node, after a shuffle where they are many. The driver holds histograms only, whose size is open nodes times bins.

- Gradients are fixed-point numbers, so sums are exact: the same trees under any partitioning.
- Of two children only the one with fewer rows is counted; its sibling is the parent less it.
- Growth is best first. A pass opens every node that the order of gains known so far would split, so a tree takes about
  as many passes as it is deep, not as it has leaves. The order is replayed until no unknown node is in it, so the tree is
  the one that splitting a single leaf at a time gives.
- Categories are ordered by gradient over hessian and cut like numbers.
- Leaf values are shrunk by L1 and L2; a split needs a gain, rows on both sides and room below leaf and depth limits.
- Margins and gradients are brought up to date once per tree, in the job of its first pass, and kept on executors. Every
  `SNAPSHOT` trees the blocks are written to the shared folder.
"""

from __future__ import annotations

import heapq
import json
import pickle
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import asdict, dataclass, field, replace
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendframe.operators.encode import fitted_labels, vocabulary
from lendframe.operators.ranking import number
from lendframe.operators.split import class_weights
from lendframe.schema import CATEGORICAL, NUMERIC
from lendframe.session import arrow_rows, materialise, shared_dir

# Default parameters of the two boosted profiles, by their usual names.
LEAFWISE: dict[str, Any] = {
    "n_estimators": 1000,
    "max_depth": 20,
    "num_leaves": 80,
    "learning_rate": 0.07,
    "subsample": 0.95,
    "colsample_bytree": 0.8,
    "reg_alpha": 0.3,
    "reg_lambda": 0.8,
    "min_child_samples": 25,
    "min_split_gain": 0.1,
}
DEPTHWISE: dict[str, Any] = {
    "n_estimators": 722,
    "max_depth": 5,
    "learning_rate": 0.05,
    "subsample": 1.0,
    "colsample_bytree": 0.6,
    "gamma": 0.2,
    "reg_alpha": 0.1,
    "reg_lambda": 0.0,
}
PATIENCE = 50
BINS = 255
SNAPSHOT = 16
SEED = 42
CATEGORY_SMOOTHING = 10.0  # hessian added when categories are ordered
MIN_HESSIAN = 1e-3
_UNIT = 1 << 24  # fixed-point steps per unit of gradient
_BATCH = 1 << 16  # most rows of a block
_LEAST_ROWS = 1 << 12  # smaller blocks are not worth the calls on them
_TASK_ROWS = 1 << 20  # most training rows a task goes over
_COLLECTED = 256  # beyond so many histograms of all tasks they are added up in a shuffle


@dataclass
class Binning:
    """Bins of a number: 0 for a missing one, then the cuts below it; of a text: its code, then one for unknown ones."""

    texts: list[str]
    numbers: list[str]
    labels: dict[str, list[str]]
    cuts: dict[str, list[float]]

    @property
    def features(self) -> list[str]:
        return [*self.texts, *self.numbers]

    @property
    def widths(self) -> np.ndarray:
        texts = [len(self.labels.get(c, ())) + 1 for c in self.texts]
        return np.array([*texts, *(len(self.cuts[c]) + 2 for c in self.numbers)], np.int64)

    def codes(self, *columns: pd.Series) -> np.ndarray:
        """Bin numbers, one row per row, in feature order."""
        out = np.empty((len(columns[0]), len(columns)), np.uint16)
        for j, (name, values) in enumerate(zip(self.features, columns)):
            if j < len(self.texts):
                known = {v: i for i, v in enumerate(self.labels.get(name, ()))}
                out[:, j] = [known.get(v, len(known)) for v in values]
            else:
                v = values.to_numpy(float, na_value=np.nan)
                place = np.searchsorted(np.array(self.cuts[name]), v, side="left") + 1
                out[:, j] = np.where(np.isnan(v), 0, place)
        return out

    def inputs(self) -> list[Column]:
        return [*[F.col(c).cast("string") for c in self.texts], *[number(c) for c in self.numbers]]


def fit_binning(rows: DataFrame, texts: Sequence[str], numbers: Sequence[str], bins: int = BINS) -> Binning:
    """Cuts at quantiles from mergeable summaries; codes by alphabetical order."""
    labels = fitted_labels(vocabulary(rows, texts)) if texts else {}
    cuts: dict[str, list[float]] = {c: [] for c in numbers}
    if numbers:
        probabilities = F.lit([i / bins for i in range(1, bins)])
        found = rows.agg(*[F.percentile_approx(number(c), probabilities, 10_000).alias(c) for c in numbers]).first()
        cuts = {c: sorted(set(found[c] or ())) for c in numbers}
    return Binning(list(texts), list(numbers), labels, cuts)


@dataclass
class Tree:
    """Node arrays; node 0 is the root. A leaf leads to itself whatever the bin."""

    feature: np.ndarray
    goes_left: np.ndarray  # (nodes, widest feature): bins that go left
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    cover: np.ndarray
    depth: int

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """Leaf of every row of a contiguous matrix of bin numbers."""
        n, width = bins.shape
        cells, first = bins.ravel(), np.arange(n) * width
        goes, widest = self.goes_left.ravel(), self.goes_left.shape[1]
        after = np.stack([self.right, self.left], axis=1).ravel()
        at = np.zeros(n, np.int64)
        for _ in range(self.depth):
            bin_ = cells.take(first + self.feature.take(at))
            at = after.take(2 * at + goes.take(at * widest + bin_))
        return at


@dataclass
class _Node:
    """A node while its tree grows: histogram (bins, 3) of fixed-point sums, best split and children."""

    sums: np.ndarray
    depth: int
    hist: np.ndarray | None = None
    split: "_Split | None" = None
    children: tuple[int, int] | None = None


@dataclass
class _Split:
    gain: float
    feature: int
    left_bins: np.ndarray
    left: np.ndarray
    right: np.ndarray


@dataclass
class Growth:
    """What a split has to meet, and which node is split next."""

    leaves: int
    depth: int
    min_rows: int = 1
    min_gain: float = 0.0
    alpha: float = 0.0
    lambda_: float = 0.0
    rate: float = 0.1
    best_first: bool = True

    def strength(self, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        cut = np.maximum(np.abs(g) - self.alpha, 0.0)
        return cut * cut / (h + self.lambda_ + 1e-12)

    def value(self, sums: np.ndarray) -> float:
        g, h = float(sums[1]) / _UNIT, float(sums[2]) / _UNIT
        return -self.rate * float(np.sign(g)) * max(abs(g) - self.alpha, 0.0) / (h + self.lambda_ + 1e-12)

    def may_split(self, node: _Node) -> bool:
        return node.depth < self.depth and int(node.sums[0]) >= 2 * self.min_rows


def best_split(hist: np.ndarray, layout: "_Layout", used: np.ndarray, growth: Growth) -> _Split | None:
    """The cut with the highest gain over all used features; the first one of equal gains."""
    n, g, h = hist[:, 0], hist[:, 1] / _UNIT, hist[:, 2] / _UNIT
    # Numbers stay in bin order; categories go by gradient over hessian, those without rows last.
    ratio = np.where(n > 0, g / (h + CATEGORY_SMOOTHING), np.inf)
    order = np.lexsort((np.where(layout.category, ratio, layout.place), layout.feature))
    upto = np.cumsum(hist[order], axis=0)
    before = np.where(layout.start[:, None] > 0, upto[layout.start - 1], 0)
    left = upto - before
    whole = hist[: layout.widths[0]].sum(axis=0)
    right = whole - left
    ok = used[layout.feature] & (left[:, 0] >= growth.min_rows) & (right[:, 0] >= growth.min_rows)
    ok &= (left[:, 2] >= MIN_HESSIAN * _UNIT) & (right[:, 2] >= MIN_HESSIAN * _UNIT)
    part = lambda s: growth.strength(s[..., 1] / _UNIT, s[..., 2] / _UNIT)
    gain = np.where(ok, part(left) + part(right) - part(whole), -np.inf)
    at = int(np.argmax(gain))
    if not gain[at] > max(growth.min_gain, 1e-9):
        return None
    j = int(layout.feature[at])
    goes = np.zeros(layout.widths.max(), bool)
    goes[layout.place[order[layout.offsets[j] : at + 1]]] = True
    return _Split(float(gain[at]), j, goes, left[at], right[at])


class _Layout:
    """Where the bins of each feature lie in a flat histogram."""

    def __init__(self, widths: np.ndarray, categories: int):
        self.widths = widths
        self.offsets = np.cumsum(widths) - widths
        self.total = int(widths.sum())
        self.feature = np.repeat(np.arange(len(widths)), widths)
        self.start = self.offsets[self.feature]
        self.place = np.arange(self.total) - self.start
        self.category = self.feature < categories


class _Growing:
    """One tree under construction: which nodes to open next, and the finished tree."""

    def __init__(self, growth: Growth, layout: _Layout, used: np.ndarray):
        self.growth, self.layout, self.used = growth, layout, used
        self.nodes: list[_Node] = []

    def add(self, hist: np.ndarray, depth: int) -> int:
        node = _Node(hist[: self.layout.widths[0]].sum(axis=0), depth, hist)
        if self.growth.may_split(node):
            node.split = best_split(hist, self.layout, self.used, self.growth)
        self.nodes.append(node)
        return len(self.nodes) - 1

    def _closed(self, split: _Split, depth: int) -> bool:
        """Neither child can be split, so their histograms are not needed."""
        most = max(int(split.left[0]), int(split.right[0]))
        return depth + 1 >= self.growth.depth or most < 2 * self.growth.min_rows

    def order(self) -> tuple[list[int], list[int]]:
        """(nodes split, in order; those of them whose children must be known to be sure of the order)."""
        rank = lambda i: (-self.nodes[i].split.gain if self.growth.best_first else self.nodes[i].depth, i)
        waiting = [rank(0)] if self.nodes[0].split else []
        chosen: list[int] = []
        unknown: list[int] = []
        while waiting and len(chosen) < self.growth.leaves - 1:
            i = heapq.heappop(waiting)[1]
            node = self.nodes[i]
            chosen.append(i)
            if node.children:
                for c in node.children:
                    if self.nodes[c].split:
                        heapq.heappush(waiting, rank(c))
            elif not self._closed(node.split, node.depth):
                unknown.append(i)
        if len(chosen) == self.growth.leaves - 1 and unknown == chosen[-1:]:
            unknown = []
        return chosen, unknown

    def routes(self, opened: Sequence[int]) -> tuple[Tree, np.ndarray, list[tuple[int, bool]]]:
        """(tree to route by, slot of every routing node or -1, (node, whether its left child is counted) per slot)."""
        feature, goes, left, right = [0], [np.ones(self.layout.widths.max(), bool)], [0], [0]
        slots, counted = [-1], []
        # Breadth first from the root; children of opened nodes are leaves with a slot for the one that is counted.
        waiting = [(0, 0)]
        depth = 0
        while waiting:
            i, at = waiting.pop(0)
            node = self.nodes[i]
            if not (node.children or i in opened):
                continue
            kids = (len(feature), len(feature) + 1)
            feature[at], goes[at], left[at], right[at] = node.split.feature, node.split.left_bins, *kids
            depth = max(depth, node.depth + 1)
            for k, own in enumerate(kids):
                feature.append(0)
                goes.append(np.ones(self.layout.widths.max(), bool))
                left.append(own)
                right.append(own)
                slots.append(-1)
                if node.children:
                    waiting.append((node.children[k], own))
            if not node.children:
                smaller_left = int(node.split.left[0]) <= int(node.split.right[0])
                slots[kids[0 if smaller_left else 1]] = len(counted)
                counted.append((i, smaller_left))
        arrays = (np.array(feature), np.array(goes), np.array(left), np.array(right))
        return Tree(*arrays, np.zeros(len(feature)), np.zeros(len(feature)), depth), np.array(slots), counted

    def open(self, counted: Sequence[tuple[int, bool]], hists: Mapping[int, np.ndarray]) -> None:
        empty = np.zeros((self.layout.total, 3), np.int64)
        for slot, (i, left_counted) in enumerate(counted):
            node = self.nodes[i]
            own = hists.get(slot, empty)
            pair = (own, node.hist - own) if left_counted else (node.hist - own, own)
            node.children = (self.add(pair[0], node.depth + 1), self.add(pair[1], node.depth + 1))
            node.hist = None

    def finished(self) -> tuple[Tree, dict[int, float]]:
        """(tree, gain per feature)."""
        chosen, _ = self.order()
        inner, gains = set(chosen), {}
        feature, goes, left, right, value, cover = [], [], [], [], [], []
        wide = np.ones(self.layout.widths.max(), bool)
        deepest = 0

        def put(sums: np.ndarray) -> int:
            at = len(feature)
            feature.append(0), goes.append(wide), left.append(at), right.append(at)
            value.append(self.growth.value(sums)), cover.append(int(sums[0]))
            return at

        waiting = [(0, put(self.nodes[0].sums))]
        while waiting:
            i, at = waiting.pop(0)
            if i not in inner:
                continue
            node = self.nodes[i]
            gains[node.split.feature] = gains.get(node.split.feature, 0.0) + node.split.gain
            deepest = max(deepest, node.depth + 1)
            feature[at], goes[at] = node.split.feature, node.split.left_bins
            left[at], right[at] = put(node.split.left), put(node.split.right)
            if node.children:
                waiting += [(node.children[0], left[at]), (node.children[1], right[at])]
        arrays = [np.array(x) for x in (feature, goes, left, right, value, cover)]
        return Tree(*arrays, deepest), gains


def _drawn(keys: np.ndarray, tree: int, share: float) -> np.ndarray:
    """Whether a row takes part in a tree: a hash of its key and the tree's number."""
    with np.errstate(over="ignore"):
        x = keys.view(np.uint64) + np.uint64((tree * 0x9E3779B97F4A7C15 + SEED) & (1 << 64) - 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x >> np.uint64(11)).astype(float) / float(1 << 53) < share


@dataclass
class Block:
    """Some rows of the training table. `bins` holds a row per feature, so a pass reads a feature in one piece.

    `g` and `h` are the fixed-point gradients for the tree that is grown, `drawn` says which rows take part in it.
    """

    bins: np.ndarray
    key: np.ndarray
    label: np.ndarray
    margin: np.ndarray
    held: bool
    g: np.ndarray | None = None
    h: np.ndarray | None = None
    drawn: np.ndarray | None = None

    def leaves(self, tree: Tree, rows: np.ndarray, wanted: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, its rows) of every wanted leaf; subtrees without one are not entered."""
        enter = wanted.copy()
        for i in range(len(enter) - 1, -1, -1):  # children come after their parents
            if tree.left[i] != i:
                enter[i] = enter[tree.left[i]] or enter[tree.right[i]]
        waiting = [(0, rows)] if enter[0] else []
        while waiting:
            i, own = waiting.pop()
            if tree.left[i] == i:
                yield i, own
                continue
            goes = tree.goes_left[i].take(self.bins[tree.feature[i]].take(own))
            if enter[tree.left[i]]:
                waiting.append((int(tree.left[i]), own[goes]))
            if enter[tree.right[i]]:
                waiting.append((int(tree.right[i]), own[~goes]))


@dataclass
class _Step:
    """Brings margins up to date with the tree before and states the gradients for the next one."""

    tree: Tree | None
    number: int
    share: float
    heavier: float

    def __call__(self, blocks: Iterator[Block]) -> Iterator[Block]:
        for b in blocks:
            margin = b.margin
            if self.tree is not None:
                margin = margin.copy()
                for leaf, rows in b.leaves(self.tree, np.arange(len(margin)), self.tree.left == np.arange(len(self.tree.left))):
                    margin[rows] += self.tree.value[leaf]
            if b.held:
                yield replace(b, margin=margin)
                continue
            p = 1 / (1 + np.exp(-margin))
            weight = np.where(b.label == 1, self.heavier, 1.0) * _UNIT
            g, h = np.rint(weight * (p - b.label)), np.rint(weight * p * (1 - p))
            small = np.int32 if self.heavier < 64 else np.int64
            drawn = _drawn(b.key, self.number, self.share) if self.share < 1 else None
            yield replace(b, margin=margin, g=g.astype(small), h=h.astype(small), drawn=drawn)


@dataclass
class _Pass:
    """One pass over the blocks: what a task adds up from them."""

    layout: _Layout
    features: np.ndarray  # those whose bins are counted
    heavier: float
    routing: Tree | None = None
    slots: np.ndarray | None = None

    def __call__(self, blocks: Iterator[Block]) -> Iterator[tuple[int, np.ndarray]]:
        """slot and the task's histogram of it; slot -1 holds loss and weight of the held rows."""
        root = self.routing is None
        count = 1 if root else int(self.slots.max()) + 1
        widths = self.layout.widths[self.features]
        totals = [np.zeros((3, count * w), np.int64) for w in widths]
        loss, seen = np.zeros(2, np.int64), False
        for b in blocks:
            if b.held:
                weight = np.where(b.label == 1, self.heavier, 1.0)
                each = weight * np.logaddexp(0, np.where(b.label == 1, -b.margin, b.margin))
                # Rounded row by row, so the loss does not depend on partitioning either.
                loss += [int(np.rint(each * _UNIT).sum()), int(np.rint(weight * _UNIT).sum())]
                continue
            rows = np.arange(len(b.margin)) if b.drawn is None else np.flatnonzero(b.drawn)
            if root:
                slot = np.zeros(1, np.int64)
                whole = b.drawn is None
            else:
                found = [(self.slots[leaf], own) for leaf, own in b.leaves(self.routing, rows, self.slots >= 0)]
                if not found:
                    continue
                slot, whole = np.repeat([s for s, _ in found], [len(own) for _, own in found]), False
                rows = np.concatenate([own for _, own in found])
            if not len(rows):
                continue
            seen = True
            g, h = (x.take(rows).astype(float) for x in (b.g, b.h))
            for j, width, total in zip(self.features, widths, totals):
                bins = b.bins[j] if whole else b.bins[j].take(rows)
                cells = slot * width + bins
                total[0] += np.bincount(cells, minlength=total.shape[1])
                # Whole numbers far below 2**53, so these sums are exact.
                total[1] += np.bincount(cells, g, total.shape[1]).astype(np.int64)
                total[2] += np.bincount(cells, h, total.shape[1]).astype(np.int64)
        if root and loss[1]:
            yield -1, loss
        if seen:
            for i in range(count):
                yield i, np.concatenate([t[:, i * w : (i + 1) * w] for t, w in zip(totals, widths)], axis=1)

    def whole(self, sums: np.ndarray) -> np.ndarray:
        """A histogram over all features, empty where nothing was counted, as (bins, 3)."""
        out = np.zeros((self.layout.total, 3), np.int64)
        out[np.isin(self.layout.feature, self.features)] = sums.T
        return out


def _summed(blocks: RDD, work: _Pass) -> dict[int, np.ndarray]:
    parts, found = blocks.mapPartitions(work), {}
    slots = 1 if work.slots is None else int(work.slots.max()) + 1
    if blocks.getNumPartitions() * slots > _COLLECTED:
        parts = parts.reduceByKey(np.add, min(slots, blocks.getNumPartitions()))
    for slot, sums in parts.collect():
        found[slot] = found[slot] + sums if slot in found else sums
    return found


@dataclass
class LeafwiseModel:
    """Trees over a binning, with what boosting measured on the way."""

    binning: Binning
    trees: list[Tree]
    start: float
    gains: dict[str, float] = field(default_factory=dict)
    losses: list[float] = field(default_factory=list)
    profile: str = "leafwise"
    version: str | None = None

    @property
    def features(self) -> list[str]:
        return self.binning.features

    def transform(self, prepared: DataFrame) -> DataFrame:
        """Add `margin`, `rawPrediction` and `probability`, the latter two as vectors of both classes."""
        missing = [c for c in self.features if c not in prepared.columns]
        if missing:
            raise ValueError(f"missing features: {missing}")
        sent = prepared.sparkSession.sparkContext.broadcast((self.binning, self.trees, self.start))

        @F.pandas_udf("double")
        def margin(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            binning, trees, start = sent.value
            for columns in batches:
                bins = binning.codes(*columns)
                total = np.full(len(bins), start)
                for tree in trees:
                    total += tree.value[tree.leaves(bins)]
                yield pd.Series(total)

        p = 1 / (1 + F.exp(-F.col("margin")))
        return (
            prepared.withColumn("margin", margin(*self.binning.inputs()))
            .withColumn("rawPrediction", array_to_vector(F.array(-F.col("margin"), F.col("margin"))))
            .withColumn("probability", array_to_vector(F.array(1 - p, p)))
        )

    def importance(self) -> list[tuple[str, float]]:
        """(feature, share of all gains), strongest first."""
        whole = sum(self.gains.values()) or 1.0
        pairs = [(f, self.gains.get(f, 0.0) / whole) for f in self.features]
        return sorted(pairs, key=lambda p: (-p[1], p[0]))

    def node_rows(self) -> Iterator[tuple]:
        """(tree, node, feature or -1, left, right, value, cover, bins that go left) of every node."""
        for t, tree in enumerate(self.trees):
            for i in range(len(tree.value)):
                inner = int(tree.left[i]) != i
                bins = np.flatnonzero(tree.goes_left[i]).tolist() if inner else []
                where = (int(tree.left[i]), int(tree.right[i])) if inner else (-1, -1)
                yield t, i, int(tree.feature[i]) if inner else -1, *where, float(tree.value[i]), float(tree.cover[i]), bins

    def save(self, spark: SparkSession, path: str) -> None:
        """Node table and description as files."""
        layout = "tree int, node int, feature int, left int, right int, value double, cover double, bins array<int>"
        spark.createDataFrame(list(self.node_rows()), layout).write.mode("overwrite").parquet(f"{path}/nodes")
        rest = {
            "binning": asdict(self.binning), "start": self.start, "gains": self.gains, "losses": self.losses,
            "profile": self.profile, "depths": [t.depth for t in self.trees], "version": self.version,
        }
        spark.createDataFrame([(json.dumps(rest),)], "text string").write.mode("overwrite").parquet(f"{path}/description")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "LeafwiseModel":
        rest = json.loads(spark.read.parquet(f"{path}/description").first().text)
        binning = Binning(**rest["binning"])
        by_tree: dict[int, list] = {}
        for r in spark.read.parquet(f"{path}/nodes").orderBy("tree", "node").collect():
            by_tree.setdefault(r.tree, []).append(r)
        trees = []
        for t, depth in enumerate(rest["depths"]):
            rows = by_tree[t]
            goes = np.ones((len(rows), int(binning.widths.max())), bool)
            for r in rows:
                if r.feature >= 0:
                    goes[r.node] = False
                    goes[r.node, r.bins] = True
            feature = np.array([max(r.feature, 0) for r in rows])
            sides = [np.array([r[s] if r.feature >= 0 else r.node for r in rows]) for s in ("left", "right")]
            trees.append(Tree(feature, goes, *sides, np.array([r.value for r in rows]), np.array([r.cover for r in rows]), depth))
        return LeafwiseModel(binning, trees, rest["start"], rest["gains"], rest["losses"], rest["profile"], rest["version"])


def growth_of(params: Mapping[str, Any], best_first: bool) -> tuple[Growth, dict[str, Any]]:
    """(growth rules, all parameters) of a profile with some parameters replaced."""
    defaults = LEAFWISE if best_first else DEPTHWISE
    unknown = set(params) - set(defaults)
    if unknown:
        raise ValueError(f"unknown parameters: {sorted(unknown)}")
    p = {**defaults, **params}
    depth = int(p["max_depth"])
    growth = Growth(
        leaves=int(p["num_leaves"]) if best_first else 1 << depth,
        depth=depth,
        min_rows=int(p.get("min_child_samples", 1)),
        # The depth-wise profile counts half the gain.
        min_gain=float(p["min_split_gain"]) if best_first else 2 * float(p["gamma"]),
        alpha=float(p["reg_alpha"]),
        lambda_=float(p["reg_lambda"]),
        rate=float(p["learning_rate"]),
        best_first=best_first,
    )
    return growth, p


def train_leafwise(
    rows: DataFrame,
    params: Mapping[str, Any] | None = None,
    validation: DataFrame | None = None,
    patience: int = PATIENCE,
    texts: Sequence[str] = tuple(CATEGORICAL),
    numbers: Sequence[str] = tuple(NUMERIC),
    class_weighted: bool = True,
    best_first: bool = True,
    bins: int = BINS,
) -> LeafwiseModel:
    """Boosted trees on rows with a 0/1 `label`.

    With `validation` rows, boosting stops after `patience` trees without a lower loss on them and keeps the trees up to
    the lowest. `best_first=False` grows level by level, as the second profile does.
    """
    growth, p = growth_of(params or {}, best_first)
    binning = fit_binning(rows, texts, numbers, bins)
    marked = rows.withColumn("held", F.lit(False))
    if validation is not None:
        marked = marked.unionByName(validation.select(*rows.columns).withColumn("held", F.lit(True)))
    counts = class_weights(rows).first()
    neg, pos = counts["neg"], counts["pos"]
    if not neg or not pos:
        raise ValueError("both classes are needed to train")
    heavier = neg / pos if class_weighted else 1.0
    start = float(np.log(pos * heavier / neg))

    spark = rows.sparkSession
    cores = spark.sparkContext.defaultParallelism
    size = int(min(max((neg + pos) // (4 * cores), _LEAST_ROWS), _BATCH))
    narrow = np.uint8 if binning.widths.max() <= 256 else np.uint16

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, label, held, *columns = (c.to_pandas() for c in batch.columns)
            bins = binning.codes(*columns).astype(narrow)
            out = []
            for side in (False, True):
                own = held.to_numpy(bool) == side
                if own.any():
                    keys, labels = key.to_numpy(np.int64)[own], label.to_numpy(float)[own]
                    block = Block(np.ascontiguousarray(bins[own].T), keys, labels, np.full(len(keys), start), side)
                    out.append(pickle.dumps(block, pickle.HIGHEST_PROTOCOL))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["block"])

    key = F.xxhash64(*binning.features, "label")
    inputs = [c.alias(f"c{i}") for i, c in enumerate(binning.inputs())]
    table = marked.select(key.alias("key"), F.col("label").cast("double").alias("label"), "held", *inputs)
    with arrow_rows(spark, size):
        binned = materialise(table.mapInArrow(cells, "block binary"), "binned")
    blocks = binned.rdd.map(lambda r: pickle.loads(r.block))
    # Blocks are dealt one by one: a task per core, more only where a task would hold too many rows.
    tasks = -(-max(1, -(-(neg + pos) // _TASK_ROWS)) // cores) * cores
    numbered = blocks.zipWithIndex().map(lambda b: (b[1], b[0]))
    blocks = numbered.partitionBy(min(tasks, -(-(neg + pos) // size)), int).values()
    return _boost(spark, blocks, binning, growth, p, start, heavier, patience, validation is not None)


def _snapshot(spark: SparkSession, blocks: RDD) -> None:
    """Have the blocks written to the shared folder by the next job: cuts lineage, survives lost executors.

    A checkpoint has a partition per file. Reading written files anew cuts those above the average size in two, so
    every snapshot would have more partitions than the one before.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark))
    blocks.checkpoint()


def _boost(
    spark: SparkSession,
    table: RDD,
    binning: Binning,
    growth: Growth,
    p: Mapping[str, Any],
    start: float,
    heavier: float,
    patience: int,
    validated: bool,
) -> LeafwiseModel:
    layout = _Layout(binning.widths, len(binning.texts))
    share, columns = float(p["subsample"]), float(p["colsample_bytree"])
    source = np.random.default_rng(SEED)
    names = binning.features
    trees: list[Tree] = []
    gains: list[dict[int, float]] = []
    losses: list[float] = []
    # Blocks as written, and with the gradients for the current tree.
    written, rows = table, None

    def passed(features: np.ndarray, **more: Any) -> dict[int, np.ndarray]:
        work = _Pass(layout, features, heavier, **more)
        return {s: x if s < 0 else work.whole(x) for s, x in _summed(rows, work).items()}

    def measure(found: Mapping[int, np.ndarray]) -> None:
        if validated:
            loss, weight = found.get(-1, (0, 0))
            losses.append(float(loss) / float(weight) if weight else 0.0)

    def advance(features: np.ndarray) -> dict[int, np.ndarray]:
        """The first pass of a tree, in the job that brings the blocks up to date."""
        nonlocal rows
        before = rows
        step = _Step(trees[-1] if trees else None, len(trees), share, heavier)
        rows = (written if before is None else before).mapPartitions(step).persist(StorageLevel.MEMORY_AND_DISK)
        if trees and len(trees) % SNAPSHOT == 0:
            _snapshot(spark, rows)
        found = passed(features)
        if before is not None:
            before.unpersist()
        return found

    try:
        while len(trees) < int(p["n_estimators"]):
            used = np.zeros(len(names), bool)
            used[source.choice(len(names), max(1, round(columns * len(names))), replace=False)] = True
            # The first feature also gives the sums of a node.
            features = np.flatnonzero(used | (np.arange(len(names)) == 0))
            found = advance(features)
            measure(found)
            # losses[k] is the loss of k trees.
            if validated and len(losses) - 1 - int(np.argmin(losses)) >= patience:
                break
            tree = _Growing(growth, layout, used)
            tree.add(found.get(0, np.zeros((layout.total, 3), np.int64)), 0)
            while True:
                _, unknown = tree.order()
                if not unknown:
                    break
                routing, slots, counted = tree.routes(unknown)
                tree.open(counted, passed(features, routing=routing, slots=slots))
            grown, gain = tree.finished()
            trees.append(grown)
            gains.append(gain)
        if validated and len(losses) == len(trees):
            measure(advance(np.zeros(1, np.int64)))
    finally:
        if rows is not None:
            rows.unpersist()
    best = int(np.argmin(losses)) if validated else len(trees)
    trees, gains = trees[:best], gains[:best]
    by_name: dict[str, float] = {}
    for gain in gains:
        for j, v in gain.items():
            by_name[names[j]] = by_name.get(names[j], 0.0) + v
    profile = "leafwise" if growth.best_first else "depthwise"
    return LeafwiseModel(binning, trees, start, by_name, losses, profile)
