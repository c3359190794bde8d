"""Keyed joins against small or large lookup tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 32


def attach(df: DataFrame, lookup: DataFrame, key: str, small: bool) -> DataFrame:
    """Left join of rows to a lookup with unique, non-NULL keys.

    `small=True` (the size was checked) broadcasts the lookup, so rows are not shuffled. Otherwise
    each row goes to one of `SALTS` copies of its key, chosen by the row's own content: a key that
    holds a large share of the rows, or the NULL key, then spreads over as many tasks.
    """
    if small:
        return df.join(F.broadcast(lookup), key, "left")
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)).cast("int"))
    copies = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(copies, [key, "_salt"], "left").drop("_salt")


def split_by_ids(df: DataFrame, ids: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows whose key is in `ids`, rows whose key is not)."""
    wanted = ids.select(key).distinct()
    return df.join(wanted, key, "left_semi"), df.join(wanted, key, "left_anti")


def align(left: DataFrame, right: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """All rows of `left` with `columns` of `right`, matched on a row key; NULL where `right` has no such row."""
    return left.join(right.select(key, *columns), key, "left")
