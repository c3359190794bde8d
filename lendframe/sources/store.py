"""Versioned feature sets: Parquet folders plus an append-only registry table."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendframe.functions.records import fingerprint

REGISTRY = (
    "seq bigint, id string, name string, version string, description string, tags map<string,string>, "
    "created_at timestamp, row_count bigint, column_count int, columns array<string>, "
    "types map<string,string>, fingerprint string, path string"
)


def new_version() -> str:
    """A version named after the current time."""
    return datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S")


class FeatureStore:
    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")

    def registry(self) -> DataFrame:
        """All saved versions, one row each."""
        try:
            return self.spark.read.schema(REGISTRY).parquet(f"{self.base}/registry")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], REGISTRY)

    def save(
        self,
        df: DataFrame,
        name: str,
        version: str | None = None,
        description: str = "",
        tags: Mapping[str, str] | None = None,
    ) -> str:
        """Write a version and make it the latest; returns its id.

        Row count and fingerprint are read from the written files, so the input plan runs once.
        """
        version = version or new_version()
        path = f"{self.base}/features/{name}/{version}"
        df.write.mode("overwrite").parquet(path)
        stored = self.spark.read.schema(df.schema).parquet(path)
        facts = fingerprint(stored).first()
        row = (
            time.time_ns(),
            f"{name}_v{version}",
            name,
            version,
            description,
            dict(tags or {}),
            datetime.now(),
            facts["rows"],
            len(df.columns),
            list(df.columns),
            {f.name: f.dataType.simpleString() for f in df.schema},
            facts["fingerprint"],
            path,
        )
        entry = self.spark.createDataFrame([row], REGISTRY).coalesce(1)
        entry.write.mode("append").parquet(f"{self.base}/registry")
        return row[1]

    def metadata(self, name: str, version: str | None = None) -> DataFrame:
        """Registry row of a version, the latest one by default."""
        rows = self.registry().filter(F.col("name") == name)
        if version is not None:
            rows = rows.filter(F.col("version") == version)
        return rows.orderBy(F.desc("seq")).limit(1)

    def load(
        self, name: str, version: str | None = None, columns: Sequence[str] | None = None
    ) -> DataFrame:
        """A version, the latest by default; only the named columns are read."""
        found = self.metadata(name, version).select("path", "columns", "types").first()
        if found is None:
            raise ValueError(f"no feature set {name}" + (f" version {version}" if version else ""))
        layout = ", ".join(f"`{c}` {found['types'][c]}" for c in found["columns"])
        df = self.spark.read.schema(layout).parquet(found["path"])
        return df.select(*columns) if columns else df

    def feature_sets(self) -> DataFrame:
        """(name, latest_version, num_versions)."""
        return (
            self.registry()
            .groupBy("name")
            .agg(
                F.max_by("version", "seq").alias("latest_version"),
                F.countDistinct("version").alias("num_versions"),
            )
        )

    def versions(self, name: str) -> DataFrame:
        """(version, created_at, row_count), oldest first."""
        rows = self.registry().filter(F.col("name") == name).orderBy("seq")
        return rows.select("version", "created_at", "row_count")
