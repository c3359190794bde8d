"""Exact inner-product search.

Method: ball-tree branch and bound per shard. Vectors are packed into shards, and shards dealt to groups of
bounded size. A task builds the trees of its group once and lets all blocks of queries pass by, one block in
memory at a time; blocks travel by the shuffle, never by the driver. A tree is searched for a whole block at
once: a node is entered only by queries whose inner-product upper bound q.c + |q| r reaches their current k-th
score, the child with the higher bound first. The k-th scores carry over from node to node and from shard to
shard of a group, and start from a search of a first shard of `FIRST_SHARD` rows.

Components become floor(256 * x). Vectors that are null, or hold null or non-finite components, take no
part; neither do rows without an id. A query meets candidates of its own length only. Repeated rows of a
query id: the smallest vector is the query; repeated candidate rows each count. Empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendframe.llm.common import arrow_batches, batch_rows
from lendframe.session import materialise

LEAF = 48
SHARD_ROWS = 4_096
FIRST_SHARD = 1_024  # rows of the shard whose k-th scores start every task
GROUP_ROWS = 131_072  # vectors whose trees a task holds, about
QUERY_BLOCK = 2_048
PACKED_ROWS = 8  # packed shards or blocks a task is handed at a time
SCALE = 256
_EXACT = float(1 << 52)


def scaled(vector: Column) -> Column:
    """floor(256 * x) per component as long; null if the vector cannot take part."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~bad, F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE)))


class Ball:
    """A node: its rows, centre, radius and, unless it is a leaf, two children."""

    def __init__(self, points: np.ndarray, rows: np.ndarray):
        own = points[rows]
        self.rows, self.centre = rows, own.mean(axis=0)
        away = ((own - self.centre) ** 2).sum(axis=1)
        self.radius = math.sqrt(float(away.max()))
        self.children: list[Ball] = []
        if len(rows) > LEAF and self.radius > 0:
            far = own[int(away.argmax())]
            other = own[int(((own - far) ** 2).sum(axis=1).argmax())]
            along = own @ (other - far)
            order = np.argsort(along, kind="stable")
            half = len(rows) // 2
            self.children = [Ball(points, rows[order[:half]]), Ball(points, rows[order[half:]])]

    def bound(self, queries: np.ndarray, norms: np.ndarray) -> np.ndarray:
        value = queries @ self.centre + norms * self.radius
        return value + np.abs(value) * 1e-9 + norms * 1e-6 + 1e-6


class Shard:
    """Vectors of one length and their tree."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.points = vectors.astype(float)
        self.largest = float(np.abs(self.points).max(initial=0))
        self.tree = Ball(self.points, np.arange(len(ids)))


class Best:
    """The k best (score, id) so far of each query of a block; equal scores go to the smaller id."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, floor: np.ndarray, k: int):
        self.ids, self.k = ids, k
        self.exact = queries
        self.queries = queries.astype(float)
        self.norms = np.sqrt((self.queries**2).sum(axis=1))
        self.floor = floor.astype(float)
        self.scores = np.full((len(ids), 0), 0, np.int64)
        self.found: list[list[tuple[int, int]]] = [[] for _ in ids]

    def search(self, shard: Shard) -> None:
        largest = shard.largest * float(np.abs(self.queries).max(initial=0))
        # Sums below 2**52 are exact as doubles; beyond that the products are taken as integers.
        self.product = shard.points if largest * shard.points.shape[1] < _EXACT else shard.vectors
        self._visit(shard.tree, np.arange(len(self.ids)), shard.ids)

    def _visit(self, ball: Ball, active: np.ndarray, ids: np.ndarray) -> None:
        active = active[ball.bound(self.queries[active], self.norms[active]) >= self.floor[active]]
        if not len(active):
            return
        if not ball.children:
            self._leaf(ball, active, ids)
            return
        left, right = (c.bound(self.queries[active], self.norms[active]) for c in ball.children)
        for first, part in ((0, active[left >= right]), (1, active[left < right])):
            for child in (ball.children[first], ball.children[1 - first]):
                self._visit(child, part, ids)

    def _leaf(self, ball: Ball, active: np.ndarray, ids: np.ndarray) -> None:
        queries = self.queries if self.product.dtype == float else self.exact
        scores = queries[active] @ self.product[ball.rows].T
        reach = (scores >= self.floor[active, None]) & (ids[ball.rows][None, :] != self.ids[active, None])
        for i in np.flatnonzero(reach.any(axis=1)).tolist():
            q = int(active[i])
            at = np.flatnonzero(reach[i])
            new = zip((-scores[i, at]).tolist(), ids[ball.rows[at]].tolist())
            best = sorted([*self.found[q], *((int(s), v) for s, v in new)])[: self.k]
            self.found[q] = best
            if len(best) == self.k:
                self.floor[q] = max(self.floor[q], float(-best[-1][0]))

    def rows(self) -> Iterator[tuple[int, int, int]]:
        for q, best in zip(self.ids.tolist(), self.found):
            for s, v in best:
                yield q, v, -s


_PACKED = "length int, n int, ids binary, vectors binary, floors binary"


def _packed(rows: DataFrame, most: int, first: list[Shard] | None = None, k: int = 0) -> DataFrame:
    """Rows (vec_id, _v) as blocks of up to `most` vectors of one length; `floors` hold k-th scores within `first`."""
    first = first or []

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            blocks = []
            for length, part in batch.groupby(batch["_v"].map(len)):
                for at in range(0, len(part) if length else 0, most):
                    ids = part["vec_id"].to_numpy(np.int64)[at : at + most]
                    vectors = np.stack(part["_v"].to_numpy()[at : at + most]).astype(np.int64)
                    best = Best(ids, vectors, np.full(len(ids), -np.inf), k)
                    for shard in first:
                        if shard.points.shape[1] == length:
                            best.search(shard)
                    blocks.append((length, len(ids), ids.tobytes(), vectors.tobytes(), best.floor.tobytes()))
            yield pd.DataFrame(blocks, columns=["length", "n", "ids", "vectors", "floors"])

    return rows.mapInPandas(run, _PACKED)


def _unpacked(row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    vectors = np.frombuffer(row.vectors, np.int64).reshape(row.n, row.length)
    return np.frombuffer(row.ids, np.int64), vectors, np.frombuffer(row.floors)


def _trees(held: dict[int, list], most: int) -> dict[int, list[Shard]]:
    """Shards of up to `most` vectors from the packed ones of a group, by length."""
    found: dict[int, list[Shard]] = {}
    for length, parts in held.items():
        ids, vectors = (np.concatenate(x) for x in list(zip(*parts))[:2])
        found[length] = [Shard(ids[at : at + most], vectors[at : at + most]) for at in range(0, len(ids), most)]
    return found


def _search(shards: DataFrame, blocks: DataFrame, groups: int, k: int, most: int) -> DataFrame:
    """query_id, vec_id, score of the k best of every query in every group of shards."""
    dealt = shards.select(F.pmod(F.xxhash64("ids"), F.lit(groups)).cast("int").alias("group"), F.lit(0).alias("asks"), "*")
    asked = blocks.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"), F.lit(1).alias("asks"), "*")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, held, trees = None, {}, None
        for batch in batches:
            for row in batch.itertuples(index=False):
                if row.group != group:
                    group, held, trees = row.group, {}, None
                if not row.asks:
                    held.setdefault(row.length, []).append(_unpacked(row))
                    continue
                if trees is None:
                    trees, held = _trees(held, most), {}
                best = Best(*_unpacked(row), k)
                for shard in trees.get(row.length, []):
                    best.search(shard)
                found = list(best.rows())
                if found:
                    yield pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype("int64")

    together = dealt.unionByName(asked).repartitionById(groups, "group").sortWithinPartitions("group", "asks")
    return together.mapInPandas(run, "query_id long, vec_id long, score long")


def _kept(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, vector: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best rows of `vectors` for each row of `queries`."""
    spark = vectors.sparkSession
    arrow_batches(spark, SHARD_ROWS)

    def usable(df: DataFrame) -> DataFrame:
        return df.select("vec_id", scaled(df[vector]).alias("_v")).where("vec_id IS NOT NULL AND _v IS NOT NULL")

    rows = usable(vectors)
    asked = usable(queries).groupBy("vec_id").agg(F.min("_v").alias("_v"))
    # k-th scores within a first shard: no task needs to look below them.
    by_length: dict[int, list] = {}
    for r in rows.limit(FIRST_SHARD).collect():
        by_length.setdefault(len(r._v), []).append(r)
    first = [
        Shard(np.array([r.vec_id for r in g], np.int64), np.array([r._v for r in g], np.int64)) for d, g in by_length.items() if d
    ]
    # Packed small, so that groups get about equal shares; a tree takes up to SHARD_ROWS of its group.
    shards = materialise(_packed(rows, max(1, SHARD_ROWS // 16)), "shards")
    blocks = materialise(_packed(asked, QUERY_BLOCK, first, k), "query-blocks")
    held = shards.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # Small tables are dealt to all cores, large ones to groups that fit a task.
    spread = min(spark.sparkContext.defaultParallelism, math.ceil(held / SHARD_ROWS))
    groups = max(1, spread, math.ceil(held / GROUP_ROWS))
    with batch_rows(spark, PACKED_ROWS):
        found = materialise(_search(shards, blocks, groups, k, SHARD_ROWS), "topk")
    return _kept(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
