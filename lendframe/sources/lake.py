"""Catalog tables and SQL over them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def lake_query(spark: SparkSession, sql: str, tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Any SELECT over catalog tables and over the given tables, which are registered as views."""
    for name, df in (tables or {}).items():
        df.createOrReplaceTempView(name)
    return spark.sql(sql)


def lake_table(spark: SparkSession, database: str, name: str) -> DataFrame:
    return spark.table(f"{database}.{name}")


def save_table(df: DataFrame, name: str, path: str | None = None, mode: str = "overwrite") -> None:
    """Write a parquet table and register it in the catalog; with `path` the files live there."""
    writer = df.write.format("parquet").mode(mode)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def update_table_schema(spark: SparkSession, name: str, df: DataFrame) -> list[str]:
    """Add to a catalog table the columns of `df` it lacks; returns their names."""
    known = {c.lower() for c in spark.table(name).columns}
    new = [f for f in df.schema if f.name.lower() not in known]
    if new:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")
    return [f.name for f in new]


def schema_inventory(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, position, column, type, rows) over several tables; one count per table."""
    out = None
    for name, df in tables.items():
        entries = [
            F.struct(
                F.lit(name).alias("table"),
                F.lit(i).alias("position"),
                F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("type"),
            )
            for i, f in enumerate(df.schema)
        ]
        rows = (
            df.agg(F.count(F.lit(1)).alias("rows"))
            .select("rows", F.explode(F.array(*entries)).alias("e"))
            .select("e.*", "rows")
        )
        out = rows if out is None else out.unionByName(rows)
    return out


def schema_difference(old: DataFrame, new: DataFrame) -> DataFrame:
    """(column, change, old_type, new_type) between two schemas."""
    before = {f.name: f.dataType.simpleString() for f in old.schema}
    after = {f.name: f.dataType.simpleString() for f in new.schema}
    rows = [(c, "added", None, t) for c, t in after.items() if c not in before]
    rows += [(c, "removed", t, None) for c, t in before.items() if c not in after]
    rows += [
        (c, "retyped", before[c], t) for c, t in after.items() if c in before and before[c] != t
    ]
    layout = "column string, change string, old_type string, new_type string"
    return new.sparkSession.createDataFrame(rows, layout)
