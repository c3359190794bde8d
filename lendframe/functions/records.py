"""Whole-row helpers: fingerprints and nested records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def fingerprint(df: DataFrame) -> DataFrame:
    """One row (rows, fingerprint): a 12-digit content hash that ignores row order.

    Two commutative folds over the row hash (xor and a wrapping-free decimal sum) make it sensitive
    to repeated rows as well. Columns are hashed with a NULL flag, so a moved NULL changes it.
    """
    parts: list[Column] = []
    for c in sorted(df.columns):
        col = F.col(f"`{c}`")
        parts += [col, col.isNull()]
    row = F.xxhash64(*parts)
    folded = df.select(row.alias("h")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.bit_xor("h").alias("x"),
        F.sum(F.col("h").cast("decimal(20,0)")).alias("s"),
    )
    text = F.concat_ws(
        ":",
        F.lit(",".join(sorted(df.columns))),
        F.col("rows").cast("string"),
        F.coalesce(F.col("x").cast("string"), F.lit("-")),
        F.coalesce(F.col("s").cast("string"), F.lit("-")),
    )
    return folded.select("rows", F.substring(F.md5(text), 1, 12).alias("fingerprint"))


def flatten_struct(df: DataFrame, sep: str = ".") -> DataFrame:
    """Every leaf of nested struct columns as a top-level column named by its path."""

    def leaves(schema: T.StructType, path: tuple[str, ...]):
        for f in schema:
            if isinstance(f.dataType, T.StructType):
                yield from leaves(f.dataType, (*path, f.name))
            else:
                yield (*path, f.name)

    def column(path: tuple[str, ...]) -> Column:
        return F.col(".".join(f"`{p}`" for p in path)).alias(sep.join(path))

    return df.select(*[column(p) for p in leaves(df.schema, ())])
