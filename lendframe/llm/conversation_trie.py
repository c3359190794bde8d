"""Prefix trie of conversations, with totals of every subtree.

Method: time-forward processing. Nodes are sorted externally in reverse level order (Spark's sort spills); a node takes
the messages its children left in a priority queue, adds its own part and leaves a message for its parent. The
queue spills sorted runs. A shard is a whole subtree whose paths hold at most `SHARD_TURNS` turns (or the square root of
all turns, if that is more), so shards run in parallel; what their roots send is summed per parent, and one last
pass of the same kind goes over the nodes above the shard roots, of which there are about as many as shards times depth.

A prefix is named by its length and by two 64-bit exclusive-or sums over digests of its turns and their places, so
names of all prefixes come from one ordered window. How often a prefix occurs is summed by partial aggregates, so a
turn with which many conversations begin meets no single task. The ids that end at a node are packed by ranges
of (node, id) before they are hashed in order, so a node where very many conversations end costs few rows.

Rows: one per distinct prefix, the root included. Null role or text becomes empty; turns are ordered by turn, null first,
equal ones by a digest of role and text; repeated turns each count. Rows without conv_id take no part.
Texts of any length are reduced to a digest and a word count in the first step. conv_id % 20 has the sign of conv_id.
Empty tables give no rows. Other columns are never read.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import os
import pickle
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendframe.llm.common import package_on_workers
from lendframe.operators.lookup import attach
from lendframe.session import LOOKUP_ROWS, materialise

SHARD_TURNS = 1 << 16
QUEUE_MESSAGES = 200_000  # messages in memory before a run is spilled
PACK = 4_096  # ids in one packed row
STEM = 20
WORD = r"[^\x20\x09-\x0D]+"
_NODE = ("depth", "k1", "k2")


def stem_turns(conv_id: Column) -> Column:
    """How many turns a conversation takes from the conversation it stems from: 0 to 3."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % 4).cast("int")


def _turns(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 1), digest and words of every turn."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        # The length of the role keeps (role, text) pairs apart that join to the same letters.
        F.unhex(F.md5(F.concat_ws(":", F.length(role), role, text).cast("binary"))).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "digest")
    return rows.select("conv_id", F.row_number().over(order).alias("place"), "digest", "words")


def rebuilt(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 1), digest, words and length of the rebuilt conversations; place 0 stands for the root."""
    turns = materialise(_turns(conversations), "turns")
    own = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("_own"))
    # At most three turns each.
    heads = (
        turns.where((F.col("conv_id") % STEM == 0) & (F.col("place") <= 3))
        .groupBy(F.col("conv_id").alias("_stem"))
        .agg(F.sort_array(F.collect_list(F.struct("place", "digest", "words"))).alias("_head"))
    )
    wanted = stem_turns(F.col("conv_id"))
    taken = F.coalesce(F.slice("_head", F.lit(1), F.col("_h")), F.array().cast(heads.schema["_head"].dataType))
    known = (
        own.withColumn("_stem", F.col("conv_id") - F.col("conv_id") % STEM)
        .withColumn("_h", wanted)
        .join(heads, "_stem", "left")
        .withColumn("_taken", taken)
        .select(
            "conv_id",
            "_h",
            "_taken",
            F.size("_taken").alias("_n"),
            (F.size("_taken") + F.greatest(F.col("_own") - F.col("_h"), F.lit(0))).cast("long").alias("length"),
        )
    )
    known = materialise(known, "stems")
    nothing = F.struct(F.lit(0).alias("place"), F.unhex(F.lit("")).alias("digest"), F.lit(0).cast("long").alias("words"))
    first = known.select("conv_id", "length", F.explode(F.concat(F.array(nothing), "_taken")).alias("t"))
    rest = turns.join(known, "conv_id").where(F.col("place") > F.col("_h"))
    rest = rest.select("conv_id", (F.col("place") - F.col("_h") + F.col("_n")).alias("place"), "digest", "words", "length")
    return first.select("conv_id", "t.*", "length").unionByName(rest)


def paths(turns: DataFrame) -> DataFrame:
    """Every prefix of every rebuilt conversation: conv_id, length, words of its last turn, its name and its parent's."""
    marks = {n: F.when(F.col("place") == 0, F.lit(0).cast("long")).otherwise(F.xxhash64(F.lit(n), "place", "digest")) for n in (1, 2)}
    upto = Window.partitionBy("conv_id").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    named = turns.withColumns({f"_x{n}": m for n, m in marks.items()})
    named = named.withColumns({f"k{n}": F.bit_xor(f"_x{n}").over(upto) for n in marks})
    return named.select(
        "conv_id", "length", "words", F.col("place").cast("long").alias("depth"), "k1", "k2",
        *[F.col(f"k{n}").bitwiseXOR(F.col(f"_x{n}")).alias(f"p{n}") for n in marks],
    )


class SpillingQueue:
    """Messages to parents, smallest key first: deepest level first, then name.

    Beyond `most` messages in memory a sorted run is written to an unnamed file that only this task sees, in the folder
    Spark gives its workers for spills; a lost task starts anew.
    """

    def __init__(self, most: int = QUEUE_MESSAGES):
        self.most = most
        self._heap: list[tuple] = []
        self._runs: list[tuple[tuple, int, Iterator[tuple]]] = []  # a heap of the heads of the spilled runs
        self.spills = 0

    def push(self, message: tuple) -> None:
        heapq.heappush(self._heap, message)
        if len(self._heap) > self.most:
            self._spill()

    def _spill(self) -> None:
        where = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None
        file = tempfile.TemporaryFile(dir=where)
        self._heap.sort()
        for start in range(0, len(self._heap), 1_000):
            pickle.dump(self._heap[start : start + 1_000], file)
        self._heap = []
        file.seek(0)
        self.spills += 1
        self._advance(self._read(file), self.spills)

    @staticmethod
    def _read(file: Any) -> Iterator[tuple]:
        with file:
            while True:
                try:
                    yield from pickle.load(file)
                except EOFError:
                    return

    def _advance(self, run: Iterator[tuple], number: int) -> None:
        head = next(run, None)
        if head is not None:
            heapq.heappush(self._runs, (head, number, run))

    def pop_for(self, key: tuple) -> Iterator[tuple]:
        """Take out the messages whose first fields are `key`."""
        size = len(key)
        while True:
            spilled = self._runs and (not self._heap or self._runs[0][0] < self._heap[0])
            if spilled:
                if self._runs[0][0][:size] != key:
                    return
                head, number, run = heapq.heappop(self._runs)
                self._advance(run, number)
                yield head
            elif self._heap and self._heap[0][:size] == key:
                yield heapq.heappop(self._heap)
            else:
                return


@dataclass
class Pass:
    """Time-forward processing of one shard after another; nodes arrive in reverse level order."""

    most: int = QUEUE_MESSAGES
    queue: SpillingQueue = field(init=False)
    shard: tuple | None = field(init=False, default=None)

    def __post_init__(self) -> None:
        self.queue = SpillingQueue(self.most)

    def node(self, shard: tuple, depth: int, own: tuple, parent: tuple, top: bool, before: tuple, saved: int) -> tuple:
        """(children, leaves, saved) of a node whose messages from other shards add up to `before`."""
        if shard != self.shard:
            self.queue, self.shard = SpillingQueue(self.most), shard
        children, leaves, total = before
        for m in self.queue.pop_for((-depth, *own)):
            children, leaves, total = children + 1, leaves + m[3], total + m[4]
        leaves, total = (leaves if children else 1), total + saved
        if not top:
            self.queue.push((1 - depth, *parent, leaves, total))
        return children, leaves, total


_COLUMNS = ["s1", "s2", *_NODE, "p1", "p2", "top", "b_children", "b_leaves", "b_saved", "own_saved"]
_TOTALS = "depth long, k1 long, k2 long, p1 long, p2 long, top boolean, n_children long, n_leaves long, saved_tokens long"


def _totals(nodes: DataFrame, most: int) -> DataFrame:
    """Totals of the subtrees of `nodes`, which lie sorted by shard and reverse level order in their partitions."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        work = Pass(most)
        for batch in batches:
            found = [
                (d, k1, k2, p1, p2, top, *work.node((s1, s2), d, (k1, k2), (p1, p2), top, (bc, bl, bs), saved))
                for s1, s2, d, k1, k2, p1, p2, top, bc, bl, bs, saved in batch.itertuples(index=False, name=None)
            ]
            yield pd.DataFrame(found, columns=[c.split()[0] for c in _TOTALS.split(", ")])

    return nodes.select(*_COLUMNS).mapInPandas(run, _TOTALS)


def _key() -> Column:
    return F.struct(*_NODE)


def _ends(ends: DataFrame) -> DataFrame:
    """depth, k1, k2 and ends_sha256 of every node at which conversations end."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, ids in batch.groupby([*_NODE], sort=False)["conv_id"]:
                values = ids.tolist()
                for i in range(0, len(values), PACK):
                    rows.append((*key, values[i], ",".join(map(str, values[i : i + PACK]))))
            yield pd.DataFrame(rows, columns=[*_NODE, "first", "ids"])

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, state = None, None
        for batch in batches:
            done = []
            for *own, ids in batch[[*_NODE, "ids"]].itertuples(index=False, name=None):
                if own != key:
                    if key is not None:
                        done.append((*key, state.hexdigest()))
                    key, state = own, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pd.DataFrame(done, columns=[*_NODE, "ends_sha256"])
        if key is not None:
            yield pd.DataFrame([(*key, state.hexdigest())], columns=[*_NODE, "ends_sha256"])

    layout = "depth long, k1 long, k2 long"
    ranged = ends.repartitionByRange(*_NODE, "conv_id").sortWithinPartitions(*_NODE, "conv_id")
    packed = ranged.mapInPandas(pack, f"{layout}, first long, ids string")
    grouped = packed.repartition(*_NODE).sortWithinPartitions(*_NODE, "first")
    return grouped.mapInPandas(digest, f"{layout}, ends_sha256 string")


def trie(conversations: DataFrame, shard_turns: int = SHARD_TURNS, queue_messages: int = QUEUE_MESSAGES) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256 of every node."""
    package_on_workers(conversations.sparkSession)
    steps = materialise(paths(rebuilt(conversations)), "paths")
    nodes = steps.groupBy(*_NODE).agg(
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        # Turns from here on over all members: at least the nodes of the subtree.
        F.sum(F.col("length") - F.col("depth") + 1).alias("_size"),
        *[F.max(c).alias(c) for c in ("words", "p1", "p2")],
    )
    nodes = materialise(nodes, "nodes")
    root = nodes.where("depth = 0").select("conv_id", "_size").first()
    most = max(shard_turns, math.isqrt(root._size if root else 0))
    big = nodes.where(F.col("_size") > most).select(_key().alias("_node"), F.lit(True).alias("_big"))
    small = big.limit(LOOKUP_ROWS + 1).count() <= LOOKUP_ROWS
    marked = attach(steps.select("conv_id", "depth", "k1", "k2", _key().alias("_node")), big, "_node", small)
    # A shard root is the first node of a path that is not big; every member of a node agrees on it.
    cut = (
        marked.where("_big IS NULL")
        .groupBy(F.col("conv_id").alias("_conv"))
        .agg(F.min(F.struct("depth", "k1", "k2")).alias("_cut"))
    )
    worth = ((F.col("n_convs") - 1) * F.col("words")).alias("own_saved")
    none = [F.lit(0).cast("long").alias(c) for c in ("b_children", "b_leaves", "b_saved")]
    below = nodes.where(F.col("_size") <= most).join(cut, F.col("conv_id") == F.col("_conv"))
    below = below.select(
        F.col("_cut.k1").alias("s1"), F.col("_cut.k2").alias("s2"), *_NODE, "p1", "p2",
        (F.col("depth") == F.col("_cut.depth")).alias("top"), *none, worth,
    )
    order = (F.desc("depth"), "k1", "k2")
    within = _totals(below.repartition("s1", "s2").sortWithinPartitions("s1", "s2", *order), queue_messages)
    within = materialise(within, "shards")
    # Messages of shard roots, one row per parent.
    sent = (
        within.where("top AND depth > 0")
        .groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"))
        .agg(
            F.count(F.lit(1)).alias("b_children"),
            F.sum("n_leaves").alias("b_leaves"),
            F.sum("saved_tokens").alias("b_saved"),
        )
    )
    above = nodes.where(F.col("_size") > most).join(sent, list(_NODE), "left")
    above = above.select(
        F.lit(0).cast("long").alias("s1"), F.lit(0).cast("long").alias("s2"), *_NODE, "p1", "p2",
        (F.col("depth") == 0).alias("top"),
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("b_children", "b_leaves", "b_saved")], worth,
    )
    across = _totals(above.coalesce(1).sortWithinPartitions(*order), queue_messages)
    totals = within.unionByName(across).drop("p1", "p2", "top")
    parents = nodes.where("depth > 0").select(
        (F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("_parent")
    )
    # The root may have most of all nodes as children, so its id is a constant; other hot parents are split by AQE.
    parent = F.when(F.col("depth") == 1, F.lit(root.conv_id if root else None).cast("long")).otherwise(F.col("_parent"))
    deep = nodes.where("depth > 1").join(parents, ["depth", "p1", "p2"], "left")
    flat = nodes.where("depth <= 1").withColumn("_parent", F.lit(None).cast("long"))
    nodes = deep.unionByName(flat)
    ended = _ends(steps.where("depth = length").select("conv_id", *_NODE))
    return (
        nodes.join(totals, list(_NODE))
        .join(ended, list(_NODE), "left")
        .select(
            "conv_id", "depth", parent.alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
        )
    )
