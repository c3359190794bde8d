"""The jobs as plain functions. Each reads its input once where it can and writes tables.

Below `out`: issues, prepared, rejected, preparation, registry, evaluation, importance, scores.
"""

from __future__ import annotations

from typing import Any

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendframe.operators import explain, metrics, profile, quality, split
from lendframe.operators import score as scoring
from lendframe.operators import train as training
from lendframe.operators.prepare import PreparationEstimator, PreparationModel, add_metadata
from lendframe.operators.search import Search
from lendframe.sources.io import as_loans, read, write_partitioned
from lendframe.sources.registry import ModelRegistry


def with_row_key(raw: DataFrame) -> DataFrame:
    """Raw loans need `loan_id`: scores and rejected rows are matched by it, not by position."""
    if "loan_id" not in raw.columns:
        raise ValueError("raw loans need a loan_id column")
    return raw


def validated(raw: DataFrame, out: str, on_invalid: str = "warn") -> bool:
    """Write the issues; an invalid table stops the job only when asked to."""
    found = quality.issues(raw)
    found.write.mode("overwrite").parquet(f"{out}/issues")
    stored = raw.sparkSession.read.schema(found.schema).parquet(f"{out}/issues")
    ok = quality.verdict(stored).first()["is_valid"]
    if not ok and on_invalid == "raise":
        raise ValueError(f"invalid loans, see {out}/issues")
    return ok


def _read(spark: SparkSession, data: str) -> DataFrame:
    """The table as it is stored: a CSV column is a number where all its values are."""
    return read(spark, data, "parquet" if "." not in data.rsplit("/", 1)[-1] else None, infer=True)


def _raw(spark: SparkSession, data: str) -> DataFrame:
    return with_row_key(as_loans(_read(spark, data)))


def prepare(
    spark: SparkSession, data: str, out: str, as_of_year: int, on_invalid: str = "warn", fit_on: str = "train"
) -> PreparationModel:
    """Validate, fit and write prepared and rejected rows.

    Medians are learned on the training split; `fit_on="all"` uses every row.
    """
    validated(_read(spark, data), out, on_invalid)
    raw = _raw(spark, data)
    rows = raw if fit_on == "all" else raw.filter(split.split_column() == "train")
    model = PreparationEstimator(as_of_year).fit(rows)
    model.save(f"{out}/preparation")
    model.transform(raw).write.mode("overwrite").parquet(f"{out}/prepared")
    model.rejected(raw).write.mode("overwrite").parquet(f"{out}/rejected")
    return model


def etl(spark: SparkSession, table: str, out: str, as_of_year: int, job_name: str = "loan-etl") -> DataFrame:
    """Catalog table to partitioned Parquet; returns the statistics of the written rows.

    The rows are written once, and both statistics read the written files.
    """
    raw = spark.table(table)
    rows = PreparationEstimator(as_of_year, "etl").fit(raw).transform(raw)
    write_partitioned(add_metadata(rows, job_name), f"{out}/prepared")
    stored = spark.read.parquet(f"{out}/prepared")
    profile.target_mix(stored, "loan_status").write.mode("overwrite").parquet(f"{out}/target")
    stats = profile.numeric_stats(stored, ["int_rate", "annual_inc", "dti", "revol_util"])
    stats.write.mode("overwrite").parquet(f"{out}/statistics")
    return spark.read.schema(stats.schema).parquet(f"{out}/statistics")


def train(
    spark: SparkSession,
    data: str,
    out: str,
    as_of_year: int,
    name: str = "loan_risk",
    profile_name: str = "gbt",
    trials: int = 0,
    on_invalid: str = "warn",
    params: dict[str, Any] | None = None,
    patience: int = training.PATIENCE,
) -> str:
    """Prepare, search, train, evaluate, explain and register as staging; returns the version."""
    prepare(spark, data, out, as_of_year, on_invalid)
    prepared = spark.read.parquet(f"{out}/prepared")
    params = dict(params or {})
    if trials:
        search = Search(profile_name)
        params = search.tune(prepared.filter(split.split_column() == "train"), trials, "halving")
        search.history(prepared).write.mode("overwrite").parquet(f"{out}/search")
    model, by_split = training.train_and_evaluate(prepared, profile_name, params, patience=patience)
    by_split = by_split.persist(StorageLevel.MEMORY_AND_DISK)
    by_split.write.mode("overwrite").parquet(f"{out}/evaluation")
    test = by_split.filter("split = 'test'").first().asDict()
    by_split.unpersist()
    measured = {m: test[m] for m in metrics.METRICS if test[m] is not None}
    registry = ModelRegistry(spark, f"{out}/registry")
    version = registry.register(model, name, None, measured, params, stage="staging")
    registry.log_run(f"{name}-{version}", model, measured, params)
    if profile_name != "forest":
        rows = prepared.filter(split.split_column() == "test")
        importance = explain.global_importance(explain.explain(model, rows), model.features)
        importance.write.mode("overwrite").parquet(f"{out}/importance")
    return version


def evaluate(
    spark: SparkSession, data: str, out: str, name: str = "loan_risk", threshold: float | None = None
) -> DataFrame:
    """Metrics of the newest model on labelled raw loans; the best threshold is used unless one is given."""
    scorer = load_scorer(spark, out, name)
    rows = training.labelled(scorer.preparation.transform(_raw(spark, data)))
    scored = scoring.with_probability(scorer.model, rows)
    hist = metrics.score_histogram(scored, "p_repaid")
    result = metrics.evaluate(hist, threshold=threshold, optimize_threshold=threshold is None)
    result.write.mode("overwrite").parquet(f"{out}/test_evaluation")
    return spark.read.parquet(f"{out}/test_evaluation")


def load_scorer(
    spark: SparkSession, out: str, name: str = "loan_risk", threshold: float | None = None, stage: str | None = None
) -> scoring.Scorer:
    preparation = PreparationModel.load(spark, f"{out}/preparation")
    registry = ModelRegistry(spark, f"{out}/registry")
    model = registry.load(name, None, stage)
    limit = scoring.DEFAULT_THRESHOLD if threshold is None else threshold
    return scoring.Scorer(preparation, model, limit, model.version)


def score(
    spark: SparkSession, data: str, out: str, name: str = "loan_risk", threshold: float | None = None
) -> DataFrame:
    """Scores of raw loans, and the rows that could not be scored."""
    scorer = load_scorer(spark, out, name, threshold)
    scorer.preparation.include_target = False
    raw = _raw(spark, data)
    scorer.score(raw).write.mode("overwrite").parquet(f"{out}/scores")
    scorer.rejected(raw).write.mode("overwrite").parquet(f"{out}/unscored")
    return spark.read.parquet(f"{out}/scores")
