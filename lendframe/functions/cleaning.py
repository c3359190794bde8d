"""Cleaning rules for raw loan fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNKNOWN = "Unknown"
_BLANKS = " \t\n\r\f\v"


def emp_length_text(c: Column) -> Column:
    """Years of employment as text "0".."10", or "Unknown" when the first word is no whole number."""
    text = F.btrim(c, F.lit(_BLANKS))
    years = F.regexp_extract(c, r"^\s*([+-]?\d+)(?:\s|$)", 1).try_cast("bigint").cast("string")
    return (
        F.when(text == "10+ years", "10")
        .when(text == "< 1 year", "0")
        .otherwise(F.coalesce(years, F.lit(UNKNOWN)))
    )


def emp_length_number(c: Column) -> Column:
    """Years of employment as int, -1 for "Unknown", NULL when there are no digits (etl rules)."""
    return (
        F.when(c == "10+ years", F.lit(10))
        .when(c == "< 1 year", F.lit(0))
        .when(c == UNKNOWN, F.lit(-1))
        .otherwise(F.regexp_extract(c, r"(\d+)", 1).try_cast("int"))
    )


def zero_one_more(c: Column) -> Column:
    """Bin a count to "0", "1" or "2+"; anything else, NULL included, is "2+"."""
    return F.when(c == 0, "0").when(c == 1, "1").otherwise("2+")


def bankruptcy_bin(c: Column) -> Column:
    """As `zero_one_more`, but NULL counts as none."""
    return zero_one_more(F.coalesce(c, F.lit(0.0)))


def credit_line_date(c: Column) -> Column:
    """Date from "Jan-2010" or ISO text; NULL when neither parses."""
    text = c.cast("string")
    iso = F.try_to_timestamp(text).cast("date")
    return F.coalesce(F.try_to_date(text, "MMM-yyyy"), iso)


def null_if_nan(df: DataFrame) -> DataFrame:
    """NaN in floating columns becomes NULL, the only missing marker used here."""
    floating = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floating}) if floating else df


def target_code(c: Column) -> Column:
    """1 for repaid, 0 for charged off, NULL for any other status."""
    return F.when(c == "Fully Paid", F.lit(1)).when(c == "Charged Off", F.lit(0))


def stable_hash(id_col: Column, seed: int) -> Column:
    """Reproducible 32-bit number from a row key and a seed, the same on every engine."""
    digest = F.md5(F.concat(id_col.cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
