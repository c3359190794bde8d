"""Quality scores of documents, learned from pairwise preferences.

Method: Bradley-Terry. A document marked good is preferred to one marked poor; the chance of that
preference is the logistic function of the difference of their scores, and a score is linear in features
of the text alone. So the weights are a logistic regression without intercept on feature differences.
The raw score is then mapped to 0..1 such that `ACCEPT` lies at a quantile of the scores of all documents
the labels agree on, sampled for the weights or not: the share of poor documents among them.

Rows: one per input row. Null and empty texts have all features 0 and get a score like any other text.
Labels: a document marked both good and poor, or marked null, is not used. If either class is missing,
no pair exists and every score is `ACCEPT`.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, replace

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendframe.llm.common import per_text
from lendframe.operators.ranking import exact_quantiles
from lendframe.session import LOOKUP_ROWS, materialise

ACCEPT = 0.7
# Bound of the labelled sample the weights are learned from, per class; threshold and scoring cover every row.
SAMPLE_PER_CLASS = 4_000
PAIRS_PER_DOCUMENT = 4
REGULARISATION = 1e-4
_SPREAD = 1.0  # raw score units per logit around the threshold

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGIT = bytes(range(48, 58))
_SPACE = b" \t\n\r\x0b\x0c"
_STOP = b".,;:?'\"()-"
_ASCII_SYMBOL = bytes(b for b in range(33, 127) if b not in _UPPER + _LOWER + _DIGIT + _STOP)

FEATURES = (
    "upper", "digit", "stop", "symbol", "other_control", "word_length", "word_length_spread", "distinct_words",
    "top_word", "repeated_lines", "line_words", "symbol_words", "lone_symbol_words", "short_words", "size", "bias_short",
)


def features(text: str | None) -> list[float]:
    """`FEATURES` of a whole text; shares are of bytes, words or lines."""
    raw = (text or "").encode()
    words = raw.split()
    if not words:
        return [0.0] * len(FEATURES)
    size, n = len(raw), len(words)
    without = lambda drop: (size - len(raw.translate(None, drop))) / size
    lengths = np.fromiter(map(len, words), np.int64, n)
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    lines = [x for x in raw.split(b"\n") if x.strip()]
    trimmed = {w: w.rstrip(_ASCII_SYMBOL) for w in counts}
    marked = sum(c for w, c in counts.items() if len(trimmed[w]) < len(w) and trimmed[w])
    alone = sum(c for w, c in counts.items() if not trimmed[w])
    return [
        without(_UPPER),
        without(_DIGIT),
        without(_STOP),
        without(_ASCII_SYMBOL),
        without(bytes(b for b in range(32) if b not in _SPACE)),
        math.log1p(float(lengths.mean())),
        math.log1p(float(lengths.std())),
        len(counts) / n,
        max(counts.values()) / n,
        1 - len(set(lines)) / len(lines),
        math.log1p(n / len(lines)) / 5,
        marked / n,
        alone / n,
        float((lengths <= 3).mean()),
        math.log1p(n) / 10,
        1.0 / n,
    ]


@dataclass(frozen=True)
class QualityModel:
    """Weights of the standardised features, and the raw score that maps to `ACCEPT`."""

    centre: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]
    threshold: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return ((np.asarray(x) - np.array(self.centre)) / np.array(self.scale)) @ np.array(self.weights)

    def score(self, x: np.ndarray) -> float:
        logit = math.log(ACCEPT / (1 - ACCEPT)) + (float(self.raw(x)) - self.threshold) / _SPREAD
        return 1 / (1 + math.exp(-min(max(logit, -500.0), 500.0)))


def _agreed(labels: DataFrame) -> DataFrame:
    """_id, quality and _order of the ids whose labels agree."""
    return (
        labels.select("doc_id", "quality")
        .where("doc_id IS NOT NULL AND quality IN (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("_most"))
        .where("quality = _most")
        .select(F.col("doc_id").alias("_id"), "quality", F.xxhash64("doc_id").alias("_order"))
    )


def _sample(docs: DataFrame, agreed: DataFrame) -> DataFrame:
    """At most `SAMPLE_PER_CLASS` labelled ids per class, those with the lowest hashes."""
    known = [agreed.where(F.col("quality") == q).orderBy("_order", "_id").limit(SAMPLE_PER_CLASS) for q in (0, 1)]
    ids = known[0].unionByName(known[1])
    # Bounded by 2 * SAMPLE_PER_CLASS rows, so the texts are not shuffled.
    return docs.select("doc_id", "text").join(F.broadcast(ids), F.col("doc_id") == F.col("_id"))


def _threshold(docs: DataFrame, agreed: DataFrame, model: QualityModel) -> float:
    """The raw score between the lowest scores, as many as there are poor documents, and the others."""
    ids = agreed.select(F.col("_id").alias("doc_id"), "quality")

    def start() -> Callable[[str | None], tuple]:
        return lambda t: (float(model.raw(np.array(features(t)))),)

    named = docs.select("doc_id", "text").where("doc_id IS NOT NULL")
    if ids.limit(LOOKUP_ROWS + 1).count() <= LOOKUP_ROWS:
        scored = per_text(named.join(F.broadcast(ids), "doc_id"), "text", ("doc_id", "quality"), "raw double", start)
    else:
        # Too many ids to broadcast: scores are joined, so that texts are not shuffled.
        scored = per_text(named, "text", ("doc_id",), "raw double", start).join(ids, "doc_id")
    # A document whose rows are repeated counts once.
    once = scored.groupBy("doc_id").agg(F.max("raw").alias("raw"), F.max("quality").alias("quality"))
    once = materialise(once, "labelled-scores")
    n, poor = once.agg(F.count(F.lit(1)), F.sum(1 - F.col("quality"))).first()
    return exact_quantiles(once, ["raw"], [(poor - 0.5) / (n - 1)]).first().q0


def fit(docs: DataFrame, labels: DataFrame) -> QualityModel:
    """Learn from the documents `labels` marks; the caller leaves out what is to be held out."""
    spark = docs.sparkSession
    agreed = _agreed(labels)
    sample = per_text(_sample(docs, agreed), "text", ("doc_id", "quality"), "x array<double>", lambda: lambda t: (features(t),))
    # The sample is bounded, so its feature rows fit the driver; pairs and weights are made by Spark.
    # A document whose rows are repeated counts once.
    rows = {r.doc_id: (r.quality, r.x) for r in sample.orderBy("doc_id", "x").collect()}
    width = len(FEATURES)
    x = np.array([v[1] for v in rows.values()], dtype=float).reshape(len(rows), width)
    good = np.array([v[0] == 1 for v in rows.values()], dtype=bool)
    if not good.any() or good.all():
        return QualityModel((0.0,) * width, (1.0,) * width, (0.0,) * width, 0.0)
    centre, scale = x.mean(0), x.std(0)
    scale[scale < 1e-12] = 1.0
    z = (x - centre) / scale
    best, worst = z[good], z[~good]
    n = max(len(best), len(worst)) * PAIRS_PER_DOCUMENT
    # A fixed stride pairs every document several times with different partners.
    i, j = np.arange(n) % len(best), (np.arange(n) * 7 + np.arange(n) // len(worst)) % len(worst)
    difference = best[i] - worst[j]
    sign = np.where(np.arange(n) % 2 == 0, 1.0, -1.0)
    pairs = spark.createDataFrame(
        [(float(s > 0), (d * s).tolist()) for s, d in zip(sign, difference)], "label double, d array<double>"
    ).select("label", array_to_vector("d").alias("features"))
    model = LogisticRegression(
        fitIntercept=False, standardization=False, regParam=REGULARISATION, maxIter=60, tol=1e-8
    ).fit(pairs)
    weights = model.coefficients.toArray()
    model = QualityModel(tuple(centre.tolist()), tuple(scale.tolist()), tuple(weights.tolist()), 0.0)
    return replace(model, threshold=_threshold(docs, agreed, model))


def score(docs: DataFrame, model: QualityModel, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`keep` columns, score (0..1) and predicted (1 from `ACCEPT` on) per row."""

    def start() -> Callable[[str | None], tuple]:
        def row(t: str | None) -> tuple:
            s = model.score(np.array(features(t)))
            return s, int(s >= ACCEPT)

        return row

    return per_text(docs, text, keep, "score double, predicted int", start)
