"""Log and status of arriving data files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendframe.sources.io import list_files

# Suffixes accepted as data files, in any case.
DATA_SUFFIXES = (".csv", ".parquet", ".json")


def is_data_file(path: Column) -> Column:
    return F.lower(path).rlike("(" + "|".join("\\" + s for s in DATA_SUFFIXES) + ")$")


def log_rows(files: DataFrame) -> DataFrame:
    """(path, size, modified, ingested_at, status) of the data files among `files`."""
    return files.filter(is_data_file(F.col("path"))).select(
        "path",
        "size",
        "modified",
        F.current_timestamp().alias("ingested_at"),
        F.lit("ingested").alias("status"),
    )


def ingestion_log(spark: SparkSession, folder: str) -> DataFrame:
    """Log rows for all data files below a folder."""
    return log_rows(list_files(spark, folder))


def ingestion_status(files: DataFrame) -> DataFrame:
    """(file_count, total_mb), MB rounded to two digits."""
    return files.agg(
        F.count(F.lit(1)).alias("file_count"),
        F.round(F.coalesce(F.sum("size"), F.lit(0)) / F.lit(1048576.0), 2).alias("total_mb"),
    )


def first_files(files: DataFrame, n: int = 10) -> DataFrame:
    """The first `n` files by path."""
    return files.select("path", "size", "modified").orderBy("path").limit(n)
