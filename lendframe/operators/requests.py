"""Bounds on single loan applications, checked row by row in the plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendframe.schema import REQUEST_BOUNDS, REQUEST_DEFAULTS


def with_defaults(df: DataFrame) -> DataFrame:
    """Optional fields an application may leave out get their defaults."""
    fills = {}
    for name, value in REQUEST_DEFAULTS.items():
        given = F.coalesce(F.col(name), F.lit(value)) if name in df.columns else F.lit(value)
        fills[name] = given
    return df.withColumns(fills)


def broken_bounds(df: DataFrame) -> Column:
    """Names of the fields of a row that are missing or out of bounds."""
    checks = []
    for name, (low, high, required) in REQUEST_BOUNDS.items():
        if name not in df.columns:
            if required:
                checks.append(F.lit(name))
            continue
        bad = F.col(name).isNull() if required else F.lit(False)
        if low is not None:
            bad = bad | F.coalesce(F.col(name) < low, F.lit(False))
        if high is not None:
            bad = bad | F.coalesce(F.col(name) > high, F.lit(False))
        checks.append(F.when(bad, F.lit(name)))
    return F.array_compact(F.array(*checks))


def check_requests(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, refused rows with `reasons`)."""
    checked = with_defaults(df).withColumn("reasons", broken_bounds(df))
    fine = F.size("reasons") == 0
    return checked.filter(fine).drop("reasons"), checked.filter(~fine)
