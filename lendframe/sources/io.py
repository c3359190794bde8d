"""Readers and writers for files, object stores and warehouses."""

from __future__ import annotations

from pathlib import PurePosixPath

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendframe.functions.cleaning import null_if_nan
from lendframe.schema import LOAN_SCHEMA, TARGET

# File suffix to Spark format.
FORMATS = {".csv": "csv", ".parquet": "parquet", ".json": "json"}


def format_of(path: str, given: str | None = None, default: str | None = None) -> str:
    suffix = given or PurePosixPath(path).suffix.lower() or (f".{default}" if default else "")
    suffix = suffix if suffix.startswith(".") else f".{suffix}"
    if suffix not in FORMATS:
        raise ValueError(f"unsupported format: {suffix}")
    return FORMATS[suffix]


def _reader(spark: SparkSession, fmt: str, schema: T.StructType | None, infer: bool, options: dict) -> DataFrameReader:
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("inferSchema", infer)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.options(**options)


def read(
    spark: SparkSession,
    path: str,
    format: str | None = None,
    schema: T.StructType | None = None,
    infer: bool = False,
    **options,
) -> DataFrame:
    """A file or folder of CSV (with header), Parquet or JSON lines, by suffix unless named.

    Without a schema CSV columns are text; `infer=True` costs one more read. NaN becomes NULL.
    """
    fmt = format_of(path, format)
    try:
        return null_if_nan(_reader(spark, fmt, schema, infer, options).load(path))
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(path) from e
        raise


def as_loans(df: DataFrame, strict: bool = False) -> DataFrame:
    """Known columns with the types of the loan table, matched by name; text that is no number is NULL.

    Blanks are kept: the leading blank of a term is part of it.
    """
    present = {c.lower(): c for c in df.columns}
    wanted = [f for f in LOAN_SCHEMA if f.name in present]
    missing = [f.name for f in LOAN_SCHEMA if f.name not in present]
    if strict and missing:
        raise ValueError(f"missing columns: {missing}")
    typed = df.select(
        *[F.col(f"`{present[f.name]}`").try_cast(f.dataType).alias(f.name) for f in wanted]
    )
    return null_if_nan(typed)


def read_loans(spark: SparkSession, path: str, format: str | None = None, **options) -> DataFrame:
    return as_loans(read(spark, path, format, **options))


def write(
    df: DataFrame,
    path: str,
    format: str | None = None,
    mode: str = "overwrite",
    default: str = "parquet",
    **options,
) -> None:
    """A folder of files; the format follows the suffix, else the default."""
    fmt = format_of(path, format, default)
    writer = df.write.format(fmt).mode(mode).options(**options)
    if fmt == "csv":
        writer = writer.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
            "ignoreTrailingWhiteSpace", False
        )
    writer.save(path)


def write_partitioned(df: DataFrame, path: str, by: str = TARGET, mode: str = "overwrite") -> None:
    """Parquet split into one folder per value; a filter on that column then reads one folder."""
    df.write.mode(mode).partitionBy(by).parquet(path)


def write_single_file(df: DataFrame, path: str) -> None:
    """One Parquet file. Only the writing is one task; what leads to `df` stays parallel."""
    df.repartition(1).write.mode("overwrite").parquet(path)


class ObjectStore:
    """Reads and writes by key below a URI such as s3a://bucket/prefix or file:/folder."""

    def __init__(self, spark: SparkSession, prefix: str):
        self.spark = spark
        self.prefix = prefix.rstrip("/")

    def path(self, key: str) -> str:
        return f"{self.prefix}/{key.lstrip('/')}"

    def read(self, key: str, format: str | None = None, **options) -> DataFrame:
        return read(self.spark, self.path(key), format, **options)

    def write(self, df: DataFrame, key: str, format: str | None = None, **options) -> None:
        write(df, self.path(key), format, **options)

    def list_files(self, key: str = "") -> DataFrame:
        return list_files(self.spark, self.path(key))


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, size, modified) of every file below a folder; contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return found.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def jdbc_options(url: str, **options) -> dict[str, str]:
    return {"url": url, **{k: str(v) for k, v in options.items()}}


def warehouse_query(spark: SparkSession, url: str, sql: str, **options) -> DataFrame:
    """Result of a SELECT run by a warehouse.

    Pass partitionColumn, lowerBound, upperBound and numPartitions together with `dbtable` instead of
    `sql` to read in parallel.
    """
    reader = spark.read.format("jdbc").options(**jdbc_options(url, **options))
    return (reader if "dbtable" in options else reader.option("query", sql)).load()


def warehouse_write(df: DataFrame, url: str, table: str, mode: str = "overwrite", **options) -> None:
    if mode not in ("append", "overwrite"):
        raise ValueError(f"unsupported mode: {mode}")
    writer = df.write.format("jdbc").options(**jdbc_options(url, dbtable=table, **options))
    writer.mode(mode).save()
