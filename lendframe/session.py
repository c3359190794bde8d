"""Session helpers: shared work folder, and driver-side copies of proven size."""

from __future__ import annotations

import os
import re
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# A lookup up to this many rows is kept as a local relation and may be broadcast.
LOOKUP_ROWS = 50_000

# The JVM never compiles methods above 8,000 bytes of bytecode. Wide loan expressions pass that, so
# such stages run better without whole-stage generation than as one interpreted method.
SETTINGS = {"spark.sql.codegen.hugeMethodLimit": "8000"}


PACKAGE_FOLDER = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def tune(spark: SparkSession) -> SparkSession:
    """Apply `SETTINGS` where the session still has Spark's own default.

    Workers also get this package's folder on their path, for runs that were not given it at the start.
    """
    spark.sparkContext.environment.setdefault("PYTHONPATH", PACKAGE_FOLDER)
    defaults = {"spark.sql.codegen.hugeMethodLimit": "65535"}
    for name, value in SETTINGS.items():
        if spark.conf.get(name, defaults[name]) == defaults[name]:
            spark.conf.set(name, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the checkpoint folder the session names.

    Only where the session names none and is a single process is a temporary folder set in its place.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    local = "file:" + tempfile.mkdtemp(prefix="lendframe-")
    spark.sparkContext.setCheckpointDir(local)
    return local


def work_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/lendframe/{label}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = work_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def local_copy(df: DataFrame, limit: int = LOOKUP_ROWS) -> DataFrame | None:
    """`df` as a local relation when it has at most `limit` rows, else None.

    At most `limit + 1` rows ever reach the driver.
    """
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        return None
    return df.sparkSession.createDataFrame(rows, df.schema)


_ARROW_ROWS = threading.Lock()  # the setting belongs to the session, so one thread at a time changes it


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Hand `rows` rows at a time to Python in what is executed inside."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    with _ARROW_ROWS:
        before = spark.conf.get(name, "10000")
        spark.conf.set(name, str(rows))
        try:
            yield
        finally:
            spark.conf.set(name, before)
