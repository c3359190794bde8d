"""Category vocabularies and codes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendframe.operators.lookup import attach
from lendframe.session import LOOKUP_ROWS


def vocabulary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, code): the distinct texts of each column, coded in alphabetical order.

    NULL has no code of its own. All columns are gathered in one pass.
    """
    seen = (
        df.select(*[F.col(c).cast("string").alias(c) for c in columns])
        .unpivot([], list(columns), "column", "value")
        .filter(F.col("value").isNotNull())
        .distinct()
    )
    order = Window.partitionBy("column").orderBy("value")
    return seen.withColumn("code", (F.row_number().over(order) - 1).cast("int"))


def fitted_labels(vocab: DataFrame, limit: int = LOOKUP_ROWS) -> dict[str, list[str]]:
    """The vocabulary on the driver, for encoders that are part of a model; refused beyond `limit` entries.

    `code_by_table` encodes with a vocabulary of any size.
    """
    rows = vocab.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"vocabulary exceeds {limit} values: not a categorical column")
    labels: dict[str, list[str]] = {}
    for r in sorted(rows, key=lambda r: (r["column"], r["code"])):
        labels.setdefault(r["column"], []).append(r["value"])
    return labels


def indexer(labels: dict[str, list[str]], columns: Sequence[str], suffix: str = "_code") -> StringIndexerModel:
    """Spark ML indexer with a fixed vocabulary; unknown and NULL share the code after the last."""
    return StringIndexerModel.from_arrays_of_labels(
        [labels.get(c, []) for c in columns],
        inputCols=list(columns),
        outputCols=[c + suffix for c in columns],
        handleInvalid="keep",
    )


def label_encode(
    df: DataFrame, labels: dict[str, list[str]], columns: Sequence[str], suffix: str = "_code"
) -> DataFrame:
    """Add an int code per column."""
    text = df.withColumns({c: F.col(c).cast("string") for c in columns})
    coded = indexer(labels, columns, suffix).transform(text)
    return coded.withColumns({c + suffix: F.col(c + suffix).cast("int") for c in columns})


def code_by_table(
    df: DataFrame, vocab: DataFrame, columns: Sequence[str], suffix: str = "_code", limit: int = LOOKUP_ROWS
) -> DataFrame:
    """Add an int code per column from a `vocabulary` table of any size.

    As in `label_encode`, unknown values and NULL share the code after the last. A column's values are broadcast only
    where their counted number is within `limit`; beyond it they are joined with salts.
    """
    sizes = {r["column"]: r["n"] for r in vocab.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
    for c in columns:
        n = sizes.get(c, 0)
        key, code = f"_{c}_text", f"{c}{suffix}"
        values = vocab.where(F.col("column") == c).select(F.col("value").alias(key), F.col("code").alias(code))
        keyed = df.withColumn(key, F.col(c).cast("string"))
        df = attach(keyed, values, key, n <= limit).withColumn(code, F.coalesce(code, F.lit(n))).select(*df.columns, code)
    return df
