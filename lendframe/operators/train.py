"""Boosted-tree and forest training with Spark ML."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from threading import Condition
from typing import Any

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendframe.functions.cleaning import target_code
from lendframe.operators import metrics
from lendframe.operators.encode import fitted_labels, indexer, vocabulary
from lendframe.operators.split import SEED, class_weights, fold_column, split_column, three_splits
from lendframe.schema import CATEGORICAL, ID, NUMERIC, TARGET
from lendframe.session import materialise, shared_dir

FEATURES = [*CATEGORICAL, *NUMERIC]

# Default parameters of the two boosted profiles, by their usual names. Leaf counts
# and leaf penalties have no counterpart in Spark ML and are left out.
PROFILES: dict[str, dict[str, Any]] = {
    "gbt": {
        "n_estimators": 1000,
        "max_depth": 20,
        "learning_rate": 0.07,
        "subsample": 0.95,
        "colsample_bytree": 0.8,
        "min_child_samples": 25,
        "min_split_gain": 0.1,
    },
    "gbt_coded": {
        "n_estimators": 722,
        "max_depth": 5,
        "learning_rate": 0.05,
        "subsample": 1.0,
        "colsample_bytree": 0.6,
        "gamma": 0.2,
    },
    "forest": {"n_estimators": 100, "max_depth": 10, "subsample": 1.0},
}
# Usual parameter name to Spark ML parameter.
SPARK_NAMES = {
    "n_estimators": "maxIter",
    "learning_rate": "stepSize",
    "max_depth": "maxDepth",
    "subsample": "subsamplingRate",
    "colsample_bytree": "featureSubsetStrategy",
    "min_child_samples": "minInstancesPerNode",
    "min_split_gain": "minInfoGain",
    "gamma": "minInfoGain",
}
MAX_DEPTH = 30  # the deepest tree Spark ML grows
PATIENCE = 50  # rounds without a lower validation loss after which boosting stops
PART_ROWS = 1 << 18  # most encoded rows, of about 0.4 kB each, that a task goes over at a time
FIT_ROWS = 1 << 24  # most rows, of about 0.1 kB each once binned, that fits at the same time keep together
BINS = 64  # of a number; a category column gets as many as it has values


def labelled(prepared: DataFrame) -> DataFrame:
    """Prepared rows with a 0/1 `label`; rows whose status is not final are left out."""
    rows = prepared.withColumn("label", target_code(F.col(TARGET)).cast("double"))
    return rows.filter("label IS NOT NULL")


def bins_of(encoded: DataFrame) -> int:
    """Bins a tree needs: `BINS`, or the values of the widest category column among the features."""
    attributes = encoded.schema["features"].metadata.get("ml_attr", {}).get("attrs", {})
    return max([BINS, *(len(a.get("vals", ())) for a in attributes.get("nominal", ()))])


def estimator(profile: str, params: Mapping[str, Any], bins: int = BINS):
    """Untrained Spark ML classifier of a profile."""
    merged = {**PROFILES[profile], **params}
    unknown = set(merged) - set(SPARK_NAMES)
    if unknown:
        raise ValueError(f"unknown parameters: {sorted(unknown)}")
    settings = {SPARK_NAMES[k]: v for k, v in merged.items()}
    settings["maxDepth"] = int(settings["maxDepth"])
    if settings["maxDepth"] > MAX_DEPTH:
        raise ValueError(f"trees deeper than {MAX_DEPTH} are not supported: {settings['maxDepth']}")
    if "featureSubsetStrategy" in settings:
        share = float(settings["featureSubsetStrategy"])
        settings["featureSubsetStrategy"] = "all" if share >= 1.0 else str(share)
    common = dict(
        featuresCol="features", labelCol="label", weightCol="weight", maxBins=bins, seed=SEED
    )
    if profile == "forest":
        settings["numTrees"] = settings.pop("maxIter")
        settings.pop("stepSize", None)
        return RandomForestClassifier(**common, **settings)
    return GBTClassifier(**common, **settings, checkpointInterval=10)


def encoder_stages(labels: dict[str, list[str]], profile: str) -> list:
    """Category codes and the feature vector.

    "gbt" and "forest" split categories as sets; "gbt_coded" sees the alphabetical code as a number,
    because the codes pass through SQL and lose their category metadata.
    """
    suffix = "_code"
    stages: list = [indexer(labels, CATEGORICAL, suffix)]
    if profile == "gbt_coded":
        plain = ", ".join(f"CAST({c}{suffix} AS FLOAT) AS {c}{suffix}_number" for c in CATEGORICAL)
        stages.append(SQLTransformer(statement=f"SELECT *, {plain} FROM __THIS__"))
        suffix = "_code_number"
    inputs = [*[c + suffix for c in CATEGORICAL], *NUMERIC]
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features"))
    return stages


class LoanModel:
    """A fitted pipeline with the names of its features."""

    def __init__(self, pipeline: PipelineModel, profile: str, features: Sequence[str] = FEATURES):
        self.pipeline = pipeline
        self.profile = profile
        self.features = list(features)
        self.version: str | None = None

    @property
    def trees(self):
        return self.pipeline.stages[-1]

    def transform(self, prepared: DataFrame) -> DataFrame:
        missing = [c for c in self.features if c not in prepared.columns]
        if missing:
            raise ValueError(f"missing features: {missing}")
        return self.pipeline.transform(prepared)

    def importance(self) -> list[tuple[str, float]]:
        """(feature, importance), strongest first; the importances sum to 1."""
        pairs = zip(self.features, self.trees.featureImportances.toArray().tolist())
        return sorted(pairs, key=lambda p: (-p[1], p[0]))

    def save(self, path: str) -> None:
        self.pipeline.write().overwrite().save(path)

    @staticmethod
    def load(path: str, profile: str = "gbt", features: Sequence[str] = FEATURES) -> "LoanModel":
        return LoanModel(PipelineModel.load(path), profile, features)


def dealt(rows: DataFrame, most: int | None = None) -> DataFrame:
    """`rows`, dealt to more partitions where theirs would hold more than `most` (`PART_ROWS`) on average."""
    parts = -(-rows.count() // (most or PART_ROWS))
    return rows.repartition(parts) if parts > rows.rdd.getNumPartitions() else rows


def encode_rows(rows: DataFrame, profile: str, keep: Sequence[str] = ()) -> tuple[PipelineModel, DataFrame]:
    """(encoders, rows with `features`, `label` and the kept columns)."""
    labels = fitted_labels(vocabulary(rows, CATEGORICAL))
    encoders = PipelineModel(encoder_stages(labels, profile))
    inputs = dealt(rows.select(*dict.fromkeys([*keep, *FEATURES, "label"])))
    return encoders, encoders.transform(inputs).select(*keep, "features", "label")


def weighted(encoded: DataFrame, neg: int, pos: int) -> DataFrame:
    """Add `weight`: neg / pos for the positive class, 1 for the other."""
    if not pos:
        raise ValueError("no positive rows to train on")
    weight = F.when(F.col("label") == 1, F.lit(neg / pos)).otherwise(F.lit(1.0))
    return encoded.withColumn("weight", weight)


def best_rounds(losses: Sequence[float], patience: int) -> tuple[int, bool]:
    """(rounds up to the lowest loss, whether `patience` rounds without a lower one followed it)."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            return best + 1, True
    return best + 1, False


def boosted(trees: GBTClassifier, rows: DataFrame, validation: DataFrame, patience: int):
    """Boosted trees of the rounds up to the lowest validation loss.

    Spark's own rule stops at the first round without gain. Here more rounds are grown, twice as many each
    time, until `patience` of them brought no gain; a tree depends on its seed and the trees before it only,
    so growing the best number of rounds anew gives the same trees.
    """
    most = trees.getMaxIter()
    if validation.isEmpty():
        return trees.fit(rows)
    rounds = min(most, max(1, 2 * patience))
    while True:
        grown = trees.copy({trees.maxIter: rounds}).fit(rows)
        best, settled = best_rounds(grown.evaluateEachIteration(validation), patience)
        if settled or rounds == most:
            return grown if best == rounds else trees.copy({trees.maxIter: best}).fit(rows)
        rounds = min(most, 2 * rounds)


def fit(
    rows: DataFrame,
    profile: str = "gbt",
    params: Mapping[str, Any] | None = None,
    validation: DataFrame | None = None,
    class_weighted: bool = True,
    patience: int = PATIENCE,
) -> LoanModel:
    """Train on labelled rows; with `validation` rows, boosting stops after `patience` rounds without gain on
    them, and the rounds after the best one are cut off.

    The encoded rows are kept on executors (memory, then disk) while the trees are grown.
    """
    mark = None
    if validation is not None and profile != "forest":
        mark = "_validation"
        rows = rows.withColumn(mark, F.lit(False)).unionByName(
            validation.select(*rows.columns).withColumn(mark, F.lit(True))
        )
    return _grown(rows, mark, profile, params, class_weighted, patience)


def _grown(
    rows: DataFrame,
    mark: str | None,
    profile: str,
    params: Mapping[str, Any] | None,
    class_weighted: bool = True,
    patience: int = PATIENCE,
) -> LoanModel:
    """`fit` of one table: where `mark` is named, the rows it is true for are the validation rows."""
    shared_dir(rows.sparkSession)
    encoders, encoded = encode_rows(rows, profile, [mark] if mark else [])
    encoded = encoded.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if class_weighted:
            counts = class_weights(encoded.filter(~F.col(mark)) if mark else encoded).first()
            ready = weighted(encoded, counts["neg"], counts["pos"])
        else:
            ready = encoded.withColumn("weight", F.lit(1.0))
        untrained = estimator(profile, params or {}, bins_of(ready))
        if mark:
            trees = boosted(untrained, ready.filter(~F.col(mark)), ready.filter(mark), patience)
        else:
            trees = untrained.fit(ready)
    finally:
        encoded.unpersist()
    return LoanModel(PipelineModel([*encoders.stages, trees]), profile)


def split_metrics(model: LoanModel, rows: DataFrame, by: str = "split") -> DataFrame:
    """(by, rows, <metrics at 0.5>) from one scoring pass over all splits; `by` has few values."""
    from lendframe.operators.score import with_probability

    scored = with_probability(model, rows).select(by, "label", F.col("p_repaid").alias("score"))
    hist = metrics.score_histogram(scored, groups=[by])
    result = metrics.evaluate(hist, [by], optimize_threshold=False)
    return result.drop("tn", "fp", "fn", "tp")


def train_and_evaluate(
    prepared: DataFrame,
    profile: str = "gbt",
    params: Mapping[str, Any] | None = None,
    test_percent: int = 20,
    patience: int = PATIENCE,
) -> tuple[LoanModel, DataFrame]:
    """(model, metrics of the train and test splits); the test split also stops the boosting."""
    rows = labelled(prepared).withColumn("split", split_column(ID, test_percent))
    in_test = F.col("split") == "test"
    if profile == "forest":
        model = fit(rows.filter(~in_test).drop("split"), profile, params)
    else:
        # Marked, not cut in two and put together again: every pass before training reads the table once, and those
        # that need no split compute none.
        mark = "_validation"
        model = _grown(rows.withColumn(mark, in_test).drop("split"), mark, profile, params, patience=patience)
    return model, split_metrics(model, rows)


def train_and_test(
    prepared: DataFrame, grow: Callable[..., Any], test_percent: int = 20, validation_percent: int = 20, **options: Any
) -> tuple[Any, DataFrame]:
    """(model, metrics of the train, validation and test splits); only the validation split stops the boosting.

    `grow(rows, validation=rows, **options)` trains: `fit` of this module, or `leafwise.train_leafwise`.
    """
    rows = labelled(prepared).withColumn("split", three_splits(ID, test_percent, validation_percent))
    part = lambda s: rows.filter(F.col("split") == s).drop("split")
    model = grow(part("train"), validation=part("validation"), **options)
    return model, split_metrics(model, rows)


def with_folds(prepared: DataFrame, profile: str, folds: int) -> DataFrame:
    """Encoded labelled rows with their fold, kept on executors; unpersist when done."""
    shared_dir(prepared.sparkSession)
    rows = labelled(prepared).withColumn("fold", fold_column(ID, folds))
    _, encoded = encode_rows(rows, profile, [ID, "fold"])
    return encoded.persist(StorageLevel.MEMORY_AND_DISK)


class _Turns:
    """Lets a fit begin while the rows in training stay within `FIT_ROWS`; two fits run at any size.

    Every fit keeps its binned rows while it runs. Large ones fill the cluster alone, and more of them at a time would
    only push each other's rows to disk.
    """

    def __init__(self) -> None:
        self._changed = Condition()
        self._running: list[int] = []

    @contextmanager
    def of(self, rows: int) -> Iterator[None]:
        with self._changed:
            self._changed.wait_for(lambda: len(self._running) < 2 or sum(self._running) + rows <= FIT_ROWS)
            self._running.append(rows)
        try:
            yield
        finally:
            with self._changed:
                self._running.remove(rows)
                self._changed.notify_all()


_TURNS = _Turns()  # of all folds and trials this driver trains


def held_out_scores(
    encoded: DataFrame,
    profile: str,
    params: Mapping[str, Any],
    used: Sequence[int],
    parallelism: int = 4,
) -> DataFrame:
    """(fold, label, score): rows of each used fold, scored by a model trained on all other folds.

    Up to `parallelism` models are trained at the same time, so small fits share the cluster; large ones take turns.
    """
    counted = encoded.groupBy("fold").agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg")
    )
    counts = {r["fold"]: (r["neg"], r["pos"]) for r in counted.collect()}

    def one(k: int) -> DataFrame:
        neg = sum(n for f, (n, _) in counts.items() if f != k)
        pos = sum(p for f, (_, p) in counts.items() if f != k)
        training = weighted(encoded.filter(F.col("fold") != k), neg, pos)
        untrained = estimator(profile, params, bins_of(training))
        with _TURNS.of(neg + pos):
            trees = untrained.fit(training)
        held = trees.transform(encoded.filter(F.col("fold") == k))
        return held.select("fold", "label", vector_to_array("probability")[1].alias("score"))

    with ThreadPoolExecutor(parallelism) as pool:
        tasks = [pool.submit(inheritable_thread_target(encoded.sparkSession)(one), k) for k in used]
        parts = [t.result() for t in tasks]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def cross_validate(
    prepared: DataFrame, profile: str = "gbt", params: Mapping[str, Any] | None = None, folds: int = 5
) -> DataFrame:
    """(fold, <metrics at 0.5>): each fold is scored by a model trained on the others."""
    encoded = with_folds(prepared, profile, folds)
    try:
        scores = held_out_scores(encoded, profile, params or {}, range(folds))
        # Written once: each reader of the histogram would score all held-out rows again.
        hist = materialise(metrics.score_histogram(scores, groups=["fold"]), "fold-scores")
        found = metrics.evaluate(hist, ["fold"], optimize_threshold=False)
        rows = found.select("fold", *metrics.METRICS).collect()
    finally:
        encoded.unpersist()
    layout = "fold int, " + ", ".join(f"{m} double" for m in metrics.METRICS)
    return prepared.sparkSession.createDataFrame(rows, layout)


def cv_summary(fold_metrics: DataFrame) -> DataFrame:
    """(metric, mean, std, lowest, highest) over folds; `std` is that of the population."""
    names = [c for c in fold_metrics.columns if c != "fold"]
    return (
        fold_metrics.unpivot(["fold"], names, "metric", "value")
        .groupBy("metric")
        .agg(
            F.avg("value").alias("mean"),
            F.stddev_pop("value").alias("std"),
            F.min("value").alias("lowest"),
            F.max("value").alias("highest"),
        )
    )
