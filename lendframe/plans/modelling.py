"""Queries: training, scoring, explanation, registry, feature store and files."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import lru_cache

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendframe.operators import explain, leafwise, metrics, score, train
from lendframe.operators.features import default_registry
from lendframe.operators.lookup import align
from lendframe.operators.search import Search
from lendframe.operators.split import split_column
from lendframe.plans.catalog import AS_OF_YEAR, LINE_DATE_SQL, PREPARED_PARTS, query
from lendframe.plans.loans import loans, table
from lendframe.plans.preparation import fitted, stored
from lendframe.sources import ingest
from lendframe.sources.io import list_files
from lendframe.sources.lake import schema_inventory
from lendframe.sources.registry import ModelRegistry, compare_versions, version_stages
from lendframe.sources.store import FeatureStore
from lendframe.session import work_path
from lendframe.streaming import alerts

# Small ensembles: the queries show the jobs, not the best model.
QUICK = {"n_estimators": 10, "max_depth": 4, "learning_rate": 0.3, "subsample": 1.0, "colsample_bytree": 1.0}
QUICK_A = {**QUICK, "min_child_samples": 25, "min_split_gain": 0.0}
QUICK_B = {**QUICK, "gamma": 0.0}
TINY = {**QUICK_A, "n_estimators": 4, "max_depth": 3}


@lru_cache(maxsize=None)
def _trained(spark: SparkSession, sf_dir: str, profile: str) -> tuple[train.LoanModel, tuple]:
    """One model per table folder and profile, shared by the queries that only read it."""
    params = {"gbt": QUICK_A, "gbt_coded": QUICK_B, "forest": {"n_estimators": 10, "max_depth": 5}}[profile]
    rows = stored(spark, sf_dir)
    model, found = train.train_and_evaluate(rows, profile, params)
    return model, tuple(found.collect())


def model_of(spark: SparkSession, sf_dir: str, profile: str = "gbt") -> train.LoanModel:
    return _trained(spark, sf_dir, profile)[0]


def _split_metrics(spark: SparkSession, sf_dir: str, profile: str) -> DataFrame:
    found = _trained(spark, sf_dir, profile)[1]
    layout = "split string, " + ", ".join(f"{m} double" for m in metrics.METRICS) + ", threshold double"
    return spark.createDataFrame([tuple(r) for r in found], layout)


# Trees of the two profiles as their users train them: what stops them is the validation split.
LEAFWISE = {"n_estimators": 120, "num_leaves": 31, "max_depth": 6, "learning_rate": 0.05}
DEPTHWISE = {"n_estimators": 200, "learning_rate": 0.1}
STOP_AFTER = 25


@lru_cache(maxsize=None)
def _boosted(spark: SparkSession, sf_dir: str, best_first: bool) -> tuple[leafwise.LeafwiseModel, tuple]:
    options = {"params": LEAFWISE} if best_first else {"params": DEPTHWISE, "best_first": False, "patience": STOP_AFTER}
    model, found = train.train_and_test(stored(spark, sf_dir), leafwise.train_leafwise, **options)
    return model, tuple(found.collect())


def _boosted_metrics(spark: SparkSession, sf_dir: str, best_first: bool) -> DataFrame:
    model, found = _boosted(spark, sf_dir, best_first)
    grown = max(len(model.losses) - 1, len(model.trees))
    layout = "split string, " + ", ".join(f"{m} double" for m in metrics.METRICS)
    layout += ", threshold double, trees_grown int, trees_kept int"
    return spark.createDataFrame([(*r, grown, len(model.trees)) for r in found], layout)


@query("train_leafwise")
def train_leafwise(spark, sf_dir):
    """120 leaf-wise trees of up to 31 leaves, cut where the validation loss is lowest."""
    return _boosted_metrics(spark, sf_dir, True)


@query("train_depthwise")
def train_depthwise(spark, sf_dir):
    """Up to 200 trees of depth 5 by the second profile, at twice its rate, stopped by the validation split."""
    return _boosted_metrics(spark, sf_dir, False)


@query(
    "leafwise_invariants",
    "SELECT loan_id, TRUE AS sums_to_one, TRUE AS fits_margin, TRUE AS adds_up FROM prepared",
    PREPARED_PARTS,
)
def leafwise_invariants(spark, sf_dir):
    """Per prepared loan: what must hold between probability, margin and contributions of the leaf-wise trees."""
    model, _ = _boosted(spark, sf_dir, True)
    total = F.aggregate("contributions", F.col("base"), lambda a, c: a + c)
    odds = 1 / (1 + F.exp(-F.col("margin")))
    scored = score.score(model, stored(spark, sf_dir)).select("loan_id", "p_repaid", "p_default")
    # The sum is compared before the join, so no contributions are shuffled.
    adds_up = (F.abs(total - F.col("margin")) < 1e-9).alias("adds_up")
    explained = explain.explain(model, stored(spark, sf_dir)).select("loan_id", "margin", adds_up)
    return explained.join(scored, "loan_id").select(
        "loan_id",
        (F.abs(F.col("p_repaid") + F.col("p_default") - 1) < 1e-12).alias("sums_to_one"),
        (F.abs(odds - F.col("p_repaid")) < 1e-9).alias("fits_margin"),
        "adds_up",
    )


@query(
    "booster_invariants",
    "SELECT profile, TRUE AS stopped_or_full, TRUE AS kept_the_best, TRUE AS better_than_none, TRUE AS three_splits "
    "FROM (VALUES ('leafwise'), ('depthwise')) p(profile)",
    (),
)
def booster_invariants(spark, sf_dir):
    """Per profile: the stop rule, the cut at the lowest validation loss, and what was measured."""
    rows = []
    stored(spark, sf_dir)  # written once, before both trainings read it
    # A pass is a short job, so two trainings at a time fill the gaps between each other's jobs.
    with ThreadPoolExecutor(2) as pool:
        trainings = [pool.submit(inheritable_thread_target(spark)(_boosted), spark, sf_dir, b) for b in (True, False)]
        trained = [t.result() for t in trainings]
    rules = ((leafwise.PATIENCE, LEAFWISE["n_estimators"]), (STOP_AFTER, DEPTHWISE["n_estimators"]))
    for (model, found), (patience, most) in zip(trained, rules):
        losses = model.losses
        best = losses.index(min(losses))
        grown = len(losses) - 1
        stopped = grown - best == patience and grown <= most
        full = grown == most and grown - best <= patience
        splits = sorted(r["split"] for r in found) == ["test", "train", "validation"]
        rows.append((model.profile, stopped or full, len(model.trees) == best, losses[best] < losses[0], splits))
    layout = "profile string, stopped_or_full boolean, kept_the_best boolean, better_than_none boolean, three_splits boolean"
    return spark.createDataFrame(rows, layout)


@query("train_gbt")
def train_gbt(spark, sf_dir):
    return _split_metrics(spark, sf_dir, "gbt")


@query("train_gbt_b")
def train_gbt_b(spark, sf_dir):
    return _split_metrics(spark, sf_dir, "gbt_coded")


@query("train_forest")
def train_forest(spark, sf_dir):
    return _split_metrics(spark, sf_dir, "forest")


@query("train_val_metrics")
def train_val_metrics(spark, sf_dir):
    rows = train.labelled(stored(spark, sf_dir)).withColumn("split", split_column())
    return train.split_metrics(model_of(spark, sf_dir), rows)


@query("feature_importance")
def feature_importance(spark, sf_dir):
    pairs = model_of(spark, sf_dir).importance()
    listed = spark.createDataFrame(pairs, "feature string, importance double")
    return listed.orderBy(F.desc("importance"), "feature")


@query("cv_folds")
def cv_folds(spark, sf_dir):
    return train.cross_validate(stored(spark, sf_dir), "gbt", TINY, 5)


@query("cv_summary")
def cv_summary(spark, sf_dir):
    return train.cv_summary(train.cross_validate(stored(spark, sf_dir), "gbt", TINY, 5))


_SPACE = {
    "n_estimators": {"type": "int", "low": 2, "high": 4},
    "max_depth": {"type": "int", "low": 2, "high": 4},
    "learning_rate": {"type": "float", "low": 0.05, "high": 0.3, "log": True},
}


@query("search_history")
def search_history(spark, sf_dir):
    rows = stored(spark, sf_dir)
    search = Search("gbt", _SPACE, folds=3)
    search.tune(rows, trials=3, method="halving", shares=(0.3, 1.0))
    return search.history(rows)


@query("search_random")
def search_random(spark, sf_dir):
    rows = stored(spark, sf_dir)
    search = Search("gbt", _SPACE, folds=3)
    search.tune(rows, trials=2, method="random")
    return search.history(rows)


@query("search_guided")
def search_guided(spark, sf_dir):
    """Twelve guided draws over the learning rate, depth and size of trees; poor ones stop on a part of the rows."""
    rows = stored(spark, sf_dir)
    space = {**_SPACE, "n_estimators": {"type": "int", "low": 3, "high": 12}}
    search = Search("gbt", space, folds=3)
    search.tune(rows, trials=12, method="guided", shares=(0.3, 1.0), parallelism=4)
    return search.history(rows)


@query("score_loans")
def score_loans(spark, sf_dir):
    return score.score(model_of(spark, sf_dir), stored(spark, sf_dir), 0.5, "v1")


@query("risk_tiers")
def risk_tiers(spark, sf_dir):
    scored = score.score(model_of(spark, sf_dir), stored(spark, sf_dir))
    return scored.groupBy("risk_level").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("p_default").alias("lowest"),
        F.max("p_default").alias("highest"),
        F.min("confidence").alias("least_confident"),
    )


@query("scored_with_inputs")
def scored_with_inputs(spark, sf_dir):
    scored = score.score(model_of(spark, sf_dir), stored(spark, sf_dir))
    inputs = loans(spark, sf_dir, ["loan_id", "loan_amnt", "grade", "loan_status"])
    return align(inputs, scored, "loan_id", ["prediction", "p_repaid", "default_risk"])


@query("score_requests")
def score_requests(spark, sf_dir):
    scorer = score.Scorer(fitted(spark, sf_dir, include_target=False), model_of(spark, sf_dir))
    return scorer.score_requests(loans(spark, sf_dir).drop("loan_status"))[0]


@query(
    "request_outcomes",
    "SELECT loans.loan_id, CASE WHEN p.loan_id IS NULL THEN 'refused' ELSE 'scored' END AS outcome, "
    "CASE WHEN annual_inc IS NULL OR annual_inc < 0 THEN 'bounds' WHEN p.loan_id IS NULL THEN 'preparation' END AS stage "
    "FROM loans LEFT JOIN (SELECT loan_id FROM prepared) p ON p.loan_id = loans.loan_id",
    PREPARED_PARTS,
)
def request_outcomes(spark, sf_dir):
    """Every request once: scored, or refused by the bounds or by preparation."""
    scorer = score.Scorer(fitted(spark, sf_dir, include_target=False), model_of(spark, sf_dir))
    return scorer.outcomes(loans(spark, sf_dir).drop("loan_status"))


@query(
    "score_invariants",
    f"SELECT loan_id, TRUE AS sums_to_one, TRUE AS within, TRUE AS fits_threshold, TRUE AS confident FROM prepared",
    PREPARED_PARTS,
)
def score_invariants(spark, sf_dir):
    """Per scored loan: what must hold between its measures."""
    scored = score.score(model_of(spark, sf_dir), stored(spark, sf_dir), 0.5, "v1")
    return scored.select(
        "loan_id",
        (F.abs(F.col("p_repaid") + F.col("p_default") - 1) < 1e-12).alias("sums_to_one"),
        F.col("p_repaid").between(0, 1).alias("within"),
        ((F.col("prediction") == 1) == (F.col("p_repaid") >= F.col("threshold"))).alias("fits_threshold"),
        (F.col("confidence") >= 0.5).alias("confident"),
    )


@query("prediction_mix")
def prediction_mix(spark, sf_dir):
    return score.prediction_mix(score.score(model_of(spark, sf_dir), stored(spark, sf_dir)))


@query("model_evaluation")
def model_evaluation(spark, sf_dir):
    rows = train.labelled(stored(spark, sf_dir)).filter(split_column() == "test")
    tables = {
        p: score.with_probability(model_of(spark, sf_dir, p), rows).select("label", F.col("p_repaid").alias("score"))
        for p in ("gbt", "gbt_coded", "forest")
    }
    return metrics.compare(tables)


# Explanation


def _explained(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str]]:
    model = model_of(spark, sf_dir)
    return explain.explain(model, stored(spark, sf_dir)), model.features


@query("shap_values")
def shap_values(spark, sf_dir):
    explained, names = _explained(spark, sf_dir)
    return explain.long_contributions(explained, names)


@query("shap_additivity", "SELECT count(*) AS rows, TRUE AS adds_up FROM prepared", PREPARED_PARTS)
def shap_additivity(spark, sf_dir):
    explained, _ = _explained(spark, sf_dir)
    total = F.aggregate("contributions", F.col("base"), lambda a, c: a + c)
    gap = F.max(F.abs(total - F.col("margin")))
    return explained.agg(F.count(F.lit(1)).alias("rows"), (gap < 1e-9).alias("adds_up"))


@query("shap_importance")
def shap_importance(spark, sf_dir):
    return explain.global_importance(*_explained(spark, sf_dir))


@query("shap_top_reasons")
def shap_top_reasons(spark, sf_dir):
    return explain.top_reasons(*_explained(spark, sf_dir))


@query("shap_waterfall")
def shap_waterfall(spark, sf_dir):
    return explain.waterfall(*_explained(spark, sf_dir))


@query("shap_dependence")
def shap_dependence(spark, sf_dir):
    explained, names = _explained(spark, sf_dir)
    return explain.dependence(explained, names, "dti", "int_rate")


# Alerts

_BASELINE_END = "2024-01-11"
_WINDOW_CELLS = """
    SELECT d, col, bin, count(*) AS k FROM (
        SELECT CAST(ts AS DATE) AS d, 'value' AS col, CASE WHEN value IS NULL THEN '' ELSE CAST((
            SELECT count(*) FROM cuts WHERE value > cut) AS VARCHAR) END AS bin FROM events
        UNION ALL
        SELECT CAST(ts AS DATE), 'event_type', CASE WHEN event_type IS NULL THEN '' WHEN event_type IN (
            SELECT event_type FROM base) THEN event_type ELSE '?' END FROM events)
    GROUP BY ALL
"""


@query(
    "drift_alerts",
    f"""
    WITH base AS (SELECT * FROM events WHERE ts < TIMESTAMP '{_BASELINE_END}'),
    cuts AS (SELECT DISTINCT unnest(quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS cut FROM base),
    cells AS ({_WINDOW_CELLS}),
    p AS (SELECT col, bin, sum(k) / (SELECT count(*) FROM base) AS p FROM cells WHERE d < DATE '{_BASELINE_END}' GROUP BY ALL),
    days AS (SELECT CAST(ts AS DATE) AS d, count(*) AS n, count(*) FILTER (WHERE event_type = 'error') / count(*) AS e
        FROM events GROUP BY ALL),
    bins AS (SELECT DISTINCT col, bin FROM cells),
    psi AS (
        SELECT days.d, bins.col, sum((greatest(coalesce(k, 0) / n, 1e-6) - greatest(coalesce(p, 0), 1e-6))
            * ln(greatest(coalesce(k, 0) / n, 1e-6) / greatest(coalesce(p, 0), 1e-6))) AS psi
        FROM days CROSS JOIN bins LEFT JOIN p ON p.col = bins.col AND p.bin = bins.bin
            LEFT JOIN cells c ON c.d = days.d AND c.col = bins.col AND c.bin = bins.bin
        GROUP BY ALL)
    SELECT CAST(days.d AS VARCHAR) AS day, n AS rows, e AS error_rate, round(v.psi, 9) AS psi_value,
        round(t.psi, 9) AS psi_event_type,
        concat_ws(',', CASE WHEN e > 0.01 THEN 'error_rate' END, CASE WHEN v.psi > 0.1 THEN 'value' END,
            CASE WHEN t.psi > 0.1 THEN 'event_type' END) AS alerts
    FROM days JOIN psi v ON v.d = days.d AND v.col = 'value' JOIN psi t ON t.d = days.d AND t.col = 'event_type'
    """,
    (),
)
def drift_alerts(spark, sf_dir):
    """Drift of value and event type against the first ten days, and error rate, per day; computed as a stream."""
    events = table(spark, sf_dir, "events")
    watched = alerts.baseline(events.where(f"ts < TIMESTAMP_NTZ '{_BASELINE_END}'"), ["event_type"], ["value"])
    watched.sort(key=lambda w: w.name, reverse=True)
    reader = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 4)
    # One file or a folder of files; files may come in any order of time, so the delay spans the table.
    rows = reader.option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir}/events*.parquet")
    out = work_path(spark, "alerts")
    measured = alerts.monitor(rows, watched, F.col("event_type") == "error", delay="3650 days")
    alerts.alert_stream(measured, out, work_path(spark, "alerts-checkpoint")).awaitTermination()
    day = F.date_from_unix_date((F.unix_seconds("window_start") / 86_400).cast("int")).cast("string").alias("day")
    raised = F.array_join("alerts", ",").alias("alerts")
    indexes = [F.round(c, 9).alias(c) for c in ("psi_value", "psi_event_type")]
    return alerts.newest_windows(spark, out).select(day, "rows", "error_rate", *indexes, raised)


# Registry and feature store


@lru_cache(maxsize=None)
def _registered(spark: SparkSession, sf_dir: str) -> ModelRegistry:
    registry = ModelRegistry(spark, work_path(spark, "registry"))
    for version, profile in (("v1", "gbt"), ("v2", "gbt_coded"), ("v3", "forest")):
        model, found = _trained(spark, sf_dir, profile)
        test = next(r for r in found if r["split"] == "test").asDict()
        measured = {m: test[m] for m in metrics.METRICS}
        registry.register(model, "loan_risk", version, measured, stage="staging")
        registry.log_run(f"run-{version}", model, measured, {"profile": profile})
    registry.promote("loan_risk", "v1", "production")
    registry.promote("loan_risk", "v2", "production")
    return registry


@query("registry_state")
def registry_state(spark, sf_dir):
    return version_stages(_registered(spark, sf_dir).events())


@query("registry_models")
def registry_models(spark, sf_dir):
    return _registered(spark, sf_dir).models()


@query("registry_compare")
def registry_compare(spark, sf_dir):
    events = _registered(spark, sf_dir).events()
    return compare_versions(events, "loan_risk", ["v1", "v2"], ["auc", "accuracy", "f1"])


@query("run_log")
def run_log(spark, sf_dir):
    return _registered(spark, sf_dir).runs()


def _stored(spark: SparkSession, sf_dir: str) -> FeatureStore:
    store = FeatureStore(spark, work_path(spark, "features"))
    built, _ = default_registry(AS_OF_YEAR).create(loans(spark, sf_dir))
    store.save(built.select("loan_id", "loan_to_income", "dti_bucket"), "ratios", "1", "first set")
    store.save(built.select("loan_id", "loan_to_income", "credit_age"), "ratios", "2", "second set")
    return store


@query(
    "feature_store_roundtrip",
    "SELECT loan_id, CAST(2025 - year(CAST(coalesce(try_strptime(earliest_cr_line, '%b-%Y'), "
    "TRY_CAST(earliest_cr_line AS TIMESTAMP)) AS DATE)) AS DOUBLE) AS credit_age FROM loans",
)
def feature_store_roundtrip(spark, sf_dir):
    return _stored(spark, sf_dir).load("ratios", columns=["loan_id", "credit_age"])


@query("feature_sets")
def feature_sets(spark, sf_dir):
    return _stored(spark, sf_dir).feature_sets()


# Files and schemas

_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)
# Names of the same types in the two engines.
_TYPES_SQL = (
    "CASE column_type WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string' WHEN 'FLOAT[]' THEN 'array<float>' "
    "WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'TIMESTAMP WITH TIME ZONE' THEN 'timestamp' ELSE lower(column_type) END"
)


@query(
    "schema_inventory",
    " UNION ALL ".join(
        f"SELECT table_name AS \"table\", CAST(ordinal_position - 1 AS INTEGER) AS position, column_name AS \"column\", "
        f"{_TYPES_SQL} AS type, "
        f"(SELECT count(*) FROM {t}) AS rows FROM (SELECT *, row_number() OVER () AS ordinal_position, "
        f"'{t}' AS table_name FROM (DESCRIBE {t})) d"
        for t in _TABLES
    ),
    (),
)
def inventory(spark, sf_dir):
    return schema_inventory({t: table(spark, sf_dir, t) for t in _TABLES})


@query("file_listing")
def file_listing(spark, sf_dir):
    return list_files(spark, sf_dir)


@query("ingestion_log")
def ingestion_log(spark, sf_dir):
    return ingest.ingestion_log(spark, sf_dir)


@query("ingestion_status")
def ingestion_status(spark, sf_dir):
    return ingest.ingestion_status(list_files(spark, sf_dir))


@query("first_files")
def first_files(spark, sf_dir):
    return ingest.first_files(list_files(spark, sf_dir))
