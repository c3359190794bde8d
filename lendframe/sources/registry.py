"""Model versions as saved pipelines plus an append-only event table.

Stages are never rewritten: every registration and promotion is one event row, and the current stage
of a version is a query over the events.
"""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lendframe.operators.train import LoanModel

# Stages a version can be put in.
STAGES = ("development", "staging", "production", "archived")
EVENTS = (
    "seq bigint, event string, name string, version string, stage string, description string, "
    "created_at timestamp, algorithm string, parameters map<string,string>, metrics map<string,double>, "
    "tags map<string,string>, feature_names array<string>, importance map<string,double>, path string"
)
RUNS = "run_id string, kind string, key string, value string, logged_at timestamp"


def new_version() -> str:
    return "v" + datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S")


def version_stages(events: DataFrame) -> DataFrame:
    """(name, version, stage, created_at, metrics): the current stage of every version.

    A promotion to production archives the version that was in production just before it.
    """
    earlier = Window.partitionBy("name").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    in_production = F.when(F.col("stage") == "production", F.col("version"))
    marked = events.withColumn("_before", F.last(in_production, ignorenulls=True).over(earlier))
    archived = marked.filter(
        (F.col("event") == "promote") & (F.col("stage") == "production") & F.col("_before").isNotNull()
    ).select("name", F.col("_before").alias("version"), F.lit("archived").alias("stage"), "seq", F.lit(0).alias("k"))
    placed = events.select("name", "version", "stage", "seq", F.lit(1).alias("k")).unionByName(archived)
    current = placed.groupBy("name", "version").agg(
        F.max_by("stage", F.struct("seq", "k")).alias("stage")
    )
    facts = events.filter("event = 'register'").select("name", "version", "created_at", "metrics")
    return current.join(facts, ["name", "version"])


def model_list(events: DataFrame) -> DataFrame:
    """(name, versions_count, production_version, staging_version)."""

    def latest(stage: str):
        mine = F.when(F.col("stage") == stage, F.struct("seq", "version"))
        return F.max(mine)["version"].alias(f"{stage}_version")

    return events.groupBy("name").agg(
        F.countDistinct("version").alias("versions_count"), latest("production"), latest("staging")
    )


def compare_versions(events: DataFrame, name: str, versions: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """(version, created_at, stage, <metrics>) of the chosen versions."""
    rows = version_stages(events).filter((F.col("name") == name) & F.col("version").isin(*versions))
    return rows.select(
        "version", "created_at", "stage", *[F.col("metrics")[m].alias(m) for m in metrics]
    )


class ModelRegistry:
    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")

    def _table(self, folder: str, layout: str) -> DataFrame:
        try:
            return self.spark.read.schema(layout).parquet(f"{self.base}/{folder}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], layout)

    def events(self) -> DataFrame:
        return self._table("events", EVENTS)

    def runs(self) -> DataFrame:
        return self._table("runs", RUNS)

    def _append(self, rows: list[tuple], layout: str, folder: str) -> None:
        df = self.spark.createDataFrame(rows, layout).coalesce(1)
        df.write.mode("append").parquet(f"{self.base}/{folder}")

    def register(
        self,
        model: LoanModel,
        name: str,
        version: str | None = None,
        metrics: Mapping[str, float] | None = None,
        parameters: Mapping[str, object] | None = None,
        tags: Mapping[str, str] | None = None,
        stage: str = "development",
        description: str = "",
    ) -> str:
        """Save a fitted model as a new version; returns the version."""
        if stage not in STAGES:
            raise ValueError(f"stage must be one of {STAGES}")
        version = version or new_version()
        same = (F.col("name") == name) & (F.col("version") == version) & (F.col("event") == "register")
        if not self.events().filter(same).isEmpty():
            raise ValueError(f"{name} has a version {version} already")
        path = f"{self.base}/models/{name}/{version}"
        model.save(path)
        row = (
            time.time_ns(),
            "register",
            name,
            version,
            stage,
            description,
            datetime.now(),
            model.profile,
            {k: str(v) for k, v in (parameters or {}).items()},
            {k: float(v) for k, v in (metrics or {}).items()},
            dict(tags or {}),
            list(model.features),
            dict(model.importance()),
            path,
        )
        self._append([row], EVENTS, "events")
        return version

    def _known(self, name: str) -> DataFrame:
        rows = self.events().filter(F.col("name") == name)
        if rows.isEmpty():
            raise ValueError(f"unknown model: {name}")
        return rows

    def promote(self, name: str, version: str, stage: str) -> None:
        if stage not in STAGES:
            raise ValueError(f"stage must be one of {STAGES}")
        if self._known(name).filter(F.col("version") == version).isEmpty():
            raise ValueError(f"unknown version of {name}: {version}")
        nothing = (None,) * 8
        row = (time.time_ns(), "promote", name, version, stage, None, datetime.now(), *nothing[:7])
        self._append([row], EVENTS, "events")

    def metadata(self, name: str, version: str | None = None) -> DataFrame:
        """Registration row of a version, the newest by default."""
        rows = self._known(name).filter("event = 'register'")
        if version is not None:
            rows = rows.filter(F.col("version") == version)
        return rows.orderBy(F.desc("seq")).limit(1)

    def load(self, name: str, version: str | None = None, stage: str | None = None) -> LoanModel:
        """A saved model by version, by stage, or the newest."""
        if stage is not None:
            held = self._known(name).filter(F.col("stage") == stage).agg(F.max_by("version", "seq")).first()[0]
            if held is None:
                raise ValueError(f"no {stage} version of {name}")
            version = held
        found = self.metadata(name, version).first()
        if found is None:
            raise ValueError(f"unknown version of {name}: {version}")
        model = LoanModel.load(found["path"], found["algorithm"], found["feature_names"])
        model.version = found["version"]
        return model

    def models(self) -> DataFrame:
        return model_list(self.events())

    def versions(self, name: str) -> DataFrame:
        return version_stages(self._known(name))

    def compare(self, name: str, versions: Sequence[str], metrics: Sequence[str]) -> DataFrame:
        return compare_versions(self._known(name), name, versions, metrics)

    def log_run(
        self,
        run_id: str,
        model: LoanModel,
        metrics: Mapping[str, float],
        parameters: Mapping[str, object] | None = None,
        tags: Mapping[str, str] | None = None,
        top: int = 20,
    ) -> None:
        """Append parameters, metrics, tags and the strongest feature importances of a run."""
        now = datetime.now()
        parts = {
            "parameter": dict(parameters or {}),
            "metric": dict(metrics),
            "tag": dict(tags or {}),
            "importance": dict(model.importance()[:top]),
        }
        rows = [(run_id, kind, k, str(v), now) for kind, d in parts.items() for k, v in d.items()]
        self._append(rows, RUNS, "runs")
