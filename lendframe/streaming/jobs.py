"""Streams over arriving files: an ingestion log, and scoring with the batch plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lendframe.operators.requests import check_requests
from lendframe.operators.score import Scorer
from lendframe.schema import LOAN_SCHEMA
from lendframe.sources.ingest import log_rows
from lendframe.sources.io import format_of


def loan_stream(
    spark: SparkSession,
    folder: str,
    format: str = "json",
    schema: T.StructType = LOAN_SCHEMA,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Loan rows of the files that arrive in a folder."""
    reader = spark.readStream.format(format_of(folder, format)).schema(schema)
    if format == "csv":
        reader = reader.option("header", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def log_new_files(
    spark: SparkSession, folder: str, log: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Append one log row per new data file; file contents are not read.

    Each micro-batch owns the folder of its number, so a batch that is run again after a failure
    replaces its own rows instead of adding them twice.
    """
    files = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("recursiveFileLookup", True)
        .load(folder)
        .select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
    )

    def append(batch: DataFrame, number: int) -> None:
        log_rows(batch).write.mode("overwrite").parquet(f"{log}/batch={number}")

    writer = files.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def score_stream(
    scorer: Scorer, rows: DataFrame, out: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Write scores of arriving applications; rows out of bounds are left to `refuse_stream`."""
    accepted, _ = check_requests(rows)
    return _to_files(scorer.score(accepted), out, checkpoint, available_now)


def refuse_stream(
    scorer: Scorer, rows: DataFrame, out: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Write key, stage and reasons of the applications that `score_stream` leaves out."""
    return _to_files(scorer.refused(rows), out, checkpoint, available_now)


def _to_files(df: DataFrame, out: str, checkpoint: str, available_now: bool) -> StreamingQuery:
    writer = df.writeStream.format("parquet").option("path", out).option(
        "checkpointLocation", checkpoint
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()
