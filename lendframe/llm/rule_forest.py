"""Quality rules with an isolation forest over rule statistics.

Method: an isolation forest. Every document becomes a point of rule statistics; trees split random statistics at
random places, and a document that few splits set apart has short path lengths and a high anomaly value,
2 ** (-mean path / expected path). A document is dropped if it fails a base rule or if its anomaly value lies above
the value that all but `GOOD_LOST` of the labelled good documents stay within.

Each tree grows, in a task of its own, from `TREE_ROWS` documents drawn by hash from the whole table (the method's
own subsample); threshold and values cover every row. Texts are read once: what follows reads a table of numbers.

Rows: one per input row, of whole texts of any length; time and memory of a row are n log n in its words. Null and
empty texts have all counts 0 and fail the base rules. Repeated rows each get a row, with equal results. Ties with
the threshold are kept. Without good labels no threshold exists and only base rules decide; an empty table gives no
rows. Input columns other than id and text are never read, so their names cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendframe.llm.common import per_text
from lendframe.operators.ranking import exact_quantiles
from lendframe.session import materialise

TREES = 128
TREE_ROWS = 256
DEPTH = 8  # log2 of TREE_ROWS: deeper paths no longer tell anomalies apart
GOOD_LOST = 0.002
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
SEED = 42

_SPACE = b" \t\n\r\x0b\x0c"
_SYMBOL = b"#*$%&|<>"
_UPPER = bytes(range(65, 91))
_STOP = b".,;:!?"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
STATISTICS = ("word_length", "symbols", "repeats", "upper", "stops", "line_words", "top_word")


def repeat_words(ids: np.ndarray) -> int:
    """Words inside windows of `WINDOW` words that occur twice or more, the first time included.

    Windows of 2, 4 and 8 words are named by the names of their halves, so equality is exact.
    """
    n = len(ids)
    if n <= WINDOW:
        return 0
    names, half = ids, 1
    while half < WINDOW:
        names = np.unique(names[:-half] * n + names[half:], return_inverse=True)[1]
        half *= 2
    repeated = np.bincount(names)[names] > 1
    edges = np.zeros(n + 1, np.int64)
    edges[: len(repeated)] += repeated
    edges[WINDOW:] -= repeated
    return int((np.cumsum(edges[:n]) > 0).sum())


def measure(text: str | None) -> tuple:
    """`COUNTS` and the list of `STATISTICS` of a whole text."""
    text = text or ""
    raw = text.encode()
    words = raw.split()
    n = len(words)
    count = lambda chars: len(raw) - len(raw.translate(None, chars))
    symbols = count(_SYMBOL)
    if not n:
        return 0, 0, symbols, 0, 0, [0.0] * len(STATISTICS)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n)
    chars = len(text) - count(_SPACE)
    repeats = repeat_words(ids)
    statistics = [
        chars / n,
        symbols / n,
        repeats / n,
        count(_UPPER) / chars,
        count(_STOP) / n,
        math.log1p(n / len(lines)),
        float(np.bincount(ids).max()) / n,
    ]
    return n, chars, symbols, len(lines) - len(set(lines)), repeats, statistics


def expected_path(n: int) -> float:
    """Mean path length of an unsuccessful search among n points."""
    if n < 2:
        return 0.0
    return 2.0 * (sum(1.0 / i for i in range(1, n)) - (n - 1) / n)


def grow(points: np.ndarray, seed: int) -> np.ndarray:
    """Nodes (statistic, cut, left, right, path length) of one tree; a leaf has statistic -1."""
    source = np.random.default_rng(seed)
    nodes: list[list[float]] = []
    waiting = [(points, 0, -1, 0)]
    while waiting:
        own, depth, parent, side = waiting.pop()
        if parent >= 0:
            nodes[parent][side] = len(nodes)
        low, high = (own.min(0), own.max(0)) if len(own) else (np.zeros(1), np.zeros(1))
        open_ = np.flatnonzero(high > low)
        if depth >= DEPTH or not len(open_):
            nodes.append([-1, 0.0, 0, 0, depth + expected_path(len(own))])
            continue
        j = int(source.choice(open_))
        cut = float(source.uniform(low[j], high[j]))
        below = own[:, j] <= cut
        waiting += [(own[~below], depth + 1, len(nodes), 3), (own[below], depth + 1, len(nodes), 2)]
        nodes.append([j, cut, 0, 0, 0.0])
    return np.array(nodes)


@dataclass(frozen=True)
class RuleForest:
    """Trees as one node table each, what an average path is, and the highest anomaly value that is kept."""

    trees: tuple[np.ndarray, ...]
    scale: float
    threshold: float = math.inf

    def anomaly(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for nodes in self.trees:
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                # A leaf points to itself by staying: its statistic is -1.
                j = nodes[at, 0].astype(np.int64)
                below = x[rows, j] <= nodes[at, 1]
                at = np.where(j < 0, at, np.where(below, nodes[at, 2], nodes[at, 3]).astype(np.int64))
            total += nodes[at, 4]
        return np.exp2(-total / (max(1, len(self.trees)) * self.scale))


def statistics_of(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`keep` columns, `COUNTS`, `_statistics` and the verdict of the base rules per row; written to the work folder."""
    # One text may be far longer than others, so batches are bounded by bytes too.
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    schema = ", ".join(f"{c} long" for c in COUNTS) + ", _statistics array<double>"
    measured = per_text(docs.select(*keep, text), text, keep, schema, lambda: measure)
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    return materialise(measured.withColumn("base_failed", failed), "rule-statistics")


def fit(statistics: DataFrame) -> RuleForest:
    """Grow the trees from `statistics_of` rows; every row may be drawn."""
    total = statistics.count()
    place = F.xxhash64(F.lit(SEED), *[c for c in statistics.columns if c != "base_failed"])
    drawn = statistics.select("_statistics", place.alias("_place"))
    if total > 4 * TREES * TREE_ROWS:
        # A hash range of four times the rows needed, so that few rows are ordered.
        share = 4 * TREES * TREE_ROWS / total
        drawn = drawn.where(F.abs(F.xxhash64("_place") / float(1 << 63)) < share)
    first = Window.partitionBy("_tree").orderBy("_place", "_statistics")
    drawn = drawn.withColumn("_tree", F.pmod("_place", F.lit(TREES)).cast("int"))
    drawn = drawn.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= TREE_ROWS)

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        number = int(rows["_tree"].iloc[0])
        ordered = rows.sort_values("_n")
        nodes = grow(np.stack(ordered["_statistics"].to_numpy()), SEED + number)
        return pd.DataFrame({"tree": [number], "size": [len(rows)], "nodes": [nodes.ravel().tolist()]})

    grown = drawn.groupBy("_tree").applyInPandas(one, "tree int, size int, nodes array<double>")
    # At most TREES rows of 2 * TREE_ROWS nodes.
    rows = sorted(grown.collect(), key=lambda r: r.tree)
    sizes = [expected_path(r.size) for r in rows]
    scale = sum(sizes) / len(sizes) if rows and any(sizes) else 1.0
    return RuleForest(tuple(np.array(r.nodes).reshape(-1, 5) for r in rows), scale)


def with_anomaly(statistics: DataFrame, forest: RuleForest) -> DataFrame:
    """Add `anomaly` (0 to 1, higher: stranger) to every row."""
    sent = statistics.sparkSession.sparkContext.broadcast(forest)

    @F.pandas_udf("double")
    def value(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            x = np.stack(batch.to_numpy()) if len(batch) else np.zeros((0, len(STATISTICS)))
            yield pd.Series(sent.value.anomaly(x))

    return statistics.withColumn("anomaly", value("_statistics"))


def calibrate(scored: DataFrame, labels: DataFrame, id_column: str = "doc_id") -> float:
    """The anomaly value within which all but `GOOD_LOST` of the good documents stay.

    Good are the documents that labels mark so without contradiction and that pass the base rules; each counts once.
    """
    good = (
        labels.where("doc_id IS NOT NULL AND quality IN (0, 1)")
        .groupBy(F.col("doc_id").alias(id_column))
        .agg(F.min("quality").alias("_worst"))
        .where("_worst = 1")
    )
    known = scored.where("NOT base_failed").select(id_column, "anomaly").join(good, id_column)
    once = materialise(known.groupBy(id_column).agg(F.max("anomaly").alias("anomaly")), "good-anomalies")
    found = exact_quantiles(once, ["anomaly"], [1 - GOOD_LOST]).first()
    return math.inf if found is None or found.q0 is None else found.q0


def judge(
    docs: DataFrame, labels: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """`keep` columns (doc_id first), `COUNTS`, base_failed, kept and anomaly of every row of `docs`."""
    scored = statistics_of(docs, text, keep)
    scored = materialise(with_anomaly(scored, fit(scored)), "anomalies")
    threshold = calibrate(scored, labels, keep[0])
    kept = ~F.col("base_failed") & (F.col("anomaly") <= threshold)
    return scored.select(*keep, *COUNTS, "base_failed", kept.alias("kept"), "anomaly")
