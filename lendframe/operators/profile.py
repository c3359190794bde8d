"""Table profiling: every report is one aggregation over the table, whatever the column count."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendframe.functions.cleaning import credit_line_date
from lendframe.operators.ranking import exact_quantiles, number


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def per_column(
    df: DataFrame, columns: Sequence[str], measures: Mapping[str, Callable[[str], Column]]
) -> DataFrame:
    """(column, <measures>): one wide aggregate, turned to one row per column afterwards."""
    packed = [
        F.struct(F.lit(c).alias("column"), *[f(c).alias(m) for m, f in measures.items()])
        for c in columns
    ]
    return df.agg(F.array(*packed).alias("r")).select(F.explode("r").alias("r")).select("r.*")


def percent(part: Column, whole: Column) -> Column:
    """NULL for an empty table instead of a division error."""
    return F.try_divide(part.cast("double") * F.lit(100.0), whole.cast("double"))


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, null_count, rows)."""
    return per_column(
        df,
        list(columns or df.columns),
        {
            "null_count": lambda c: F.count_if(F.col(f"`{c}`").isNull()),
            "rows": lambda c: F.count(F.lit(1)),
        },
    )


def null_percentage(df: DataFrame) -> DataFrame:
    """(column, null_percentage) of the columns that have NULLs, highest first."""
    pct = percent(F.col("null_count"), F.col("rows"))
    return (
        null_counts(df)
        .filter("null_count > 0")
        .select("column", pct.alias("null_percentage"))
        .orderBy(F.desc("null_percentage"), "column")
    )


def null_report(df: DataFrame) -> DataFrame:
    """(column, null_count, null_percentage, non_null_count), highest first."""
    pct = F.round(percent(F.col("null_count"), F.col("rows")), 2)
    return (
        null_counts(df)
        .select(
            "column",
            "null_count",
            pct.alias("null_percentage"),
            (F.col("rows") - F.col("null_count")).alias("non_null_count"),
        )
        .orderBy(F.desc("null_percentage"), "column")
    )


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n, share): counts and shares of each column's non-NULL values."""
    counted = (
        df.select(*[F.col(c).cast("string").alias(c) for c in columns])
        .unpivot([], list(columns), "column", "value")
        .filter("value IS NOT NULL")
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    totals = counted.groupBy("column").agg(F.sum("n").alias("_total"))
    share = F.col("n").cast("double") / F.col("_total")
    return counted.join(F.broadcast(totals), "column").select("column", "value", "n", share.alias("share"))


def target_mix(df: DataFrame, target: str) -> DataFrame:
    """(target, n, percent) over the rows that have a target."""
    counted = df.filter(F.col(target).isNotNull()).groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    total = counted.agg(F.sum("n")).scalar()
    return counted.withColumn("_t", total).select(
        target, "n", percent(F.col("n"), F.col("_t")).alias("percent")
    )


def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False) -> DataFrame:
    """(column, n_distinct), NULL not counted.

    Exact counts shuffle the distinct values; the approximate form keeps one sketch per column.
    """
    names = list(columns or df.columns)
    if approximate:
        return per_column(df, names, {"n_distinct": F.approx_count_distinct})
    floating = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}

    def text(c: str) -> Column:
        # Adding zero turns -0.0 into 0.0, which it equals.
        value = F.col(f"`{c}`") + F.lit(0.0) if c in floating else F.col(f"`{c}`")
        return value.cast("string").alias(c)

    found = (
        df.select(*[text(c) for c in names])
        .unpivot([], names, "column", "value")
        .distinct()
    )
    return found.groupBy("column").agg(F.count("value").alias("n_distinct"))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """(rows, duplicate_rows, percent): rows beyond the first of each set of equal rows; NULL equals NULL.

    A row is shuffled as two 64-bit hashes of its values and of which of them are NULL, whatever its width.
    """
    parts = [p for c in df.columns for p in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    hashes = [F.xxhash64(F.lit(seed), *parts).alias(f"_h{seed}") for seed in (1, 2)]
    groups = df.select(*hashes).groupBy("_h1", "_h2").agg(F.count(F.lit(1)).alias("_n"))
    total = F.coalesce(F.sum("_n"), F.lit(0))
    repeats = F.coalesce(F.sum(F.col("_n") - 1), F.lit(0))
    return groups.agg(total.alias("rows"), repeats.alias("duplicate_rows")).withColumn(
        "percent", percent(F.col("duplicate_rows"), F.col("rows"))
    )


def summary_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, count, mean, std, min, q25, q50, q75, max)."""
    moments = per_column(
        df,
        columns,
        {
            "count": F.count,
            "mean": F.avg,
            "std": F.stddev_samp,
            "min": lambda c: F.min(F.col(c).cast("double")),
            "max": lambda c: F.max(F.col(c).cast("double")),
        },
    )
    q = exact_quantiles(df, columns, [0.25, 0.5, 0.75]).select(
        "column", F.col("q0").alias("q25"), F.col("q1").alias("q50"), F.col("q2").alias("q75")
    )
    return moments.join(F.broadcast(q), "column", "left").select(
        "column", "count", "mean", "std", "min", "q25", "q50", "q75", "max"
    )


def summary_categorical(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, count, unique, top, freq); the first value in text order wins a tie for `top`."""
    counted = (
        df.select(*[F.col(c).cast("string").alias(c) for c in columns])
        .unpivot([], list(columns), "column", "value")
        .groupBy("column", "value")
        .agg(F.count("value").alias("n"))
    )
    best = F.min(F.when(F.col("value").isNotNull(), F.struct((-F.col("n")).alias("m"), "value")))
    return counted.groupBy("column").agg(
        F.sum("n").alias("count"),
        F.count("value").alias("unique"),
        best["value"].alias("top"),
        (-best["m"]).alias("freq"),
    )


def summary(df: DataFrame) -> DataFrame:
    """One row per column, numbers and texts together; measures that do not apply are NULL."""
    numbers = summary_numeric(df, numeric_columns(df))
    texts = summary_categorical(df, text_columns(df))
    return numbers.unionByName(texts, allowMissingColumns=True)


def numeric_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, mean, std, min, max)."""
    return per_column(
        df, columns, {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    )


def corrected_skewness(c: str) -> Column:
    """Sample skewness with the usual small-sample correction; NULL below three values."""
    n = F.count(c).cast("double")
    factor = F.try_divide(F.sqrt(n * (n - 1)), n - 2)
    return F.when(n > 2, F.skewness(c) * factor)


def _block_moments(x: np.ndarray) -> np.ndarray:
    """(columns, columns, 6): rows, means, squared and crossed deviations of every pair over the rows that have both."""
    mask = ~np.isnan(x)
    n_own = mask.sum(axis=0)
    shift = np.where(n_own > 0, np.where(mask, x, 0.0).sum(axis=0) / np.maximum(n_own, 1), 0.0)
    z, m = np.where(mask, x - shift, 0.0), mask.astype(float)
    n = m.T @ m
    safe = np.maximum(n, 1.0)
    sums, squares, crossed = z.T @ m, (z * z).T @ m, z.T @ z
    mean = sums / safe
    return np.stack(
        [n, shift[:, None] + mean, shift[None, :] + mean.T, squares - sums * mean, (squares - sums * mean).T, crossed - sums * mean.T],
        axis=2,
    )


def _merged_moments(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Moments of two sets of rows together."""
    n = a[..., 0] + b[..., 0]
    share = b[..., 0] / np.maximum(n, 1.0)
    first, second = b[..., 1] - a[..., 1], b[..., 2] - a[..., 2]
    weight = a[..., 0] * share
    return np.stack(
        [
            n, a[..., 1] + first * share, a[..., 2] + second * share, a[..., 3] + b[..., 3] + first * first * weight,
            a[..., 4] + b[..., 4] + second * second * weight, a[..., 5] + b[..., 5] + first * second * weight,
        ],
        axis=-1,
    )


def _correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(i, j, correlation) of every ordered pair of column places, from one read.

    A task holds the masked moments of all pairs, as matrix products of whole Arrow batches; per first column one
    task merges what the others found. NULL below two rows or without spread.
    """
    k = len(columns)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k, 6))
        for batch in batches:
            x = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            total = _merged_moments(total, _block_moments(np.column_stack(x).astype(float)))
        data = pa.array([row.tobytes() for row in total], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(range(k), pa.int32()), data], names=["i", "data"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = np.frombuffer(data).reshape(k, 6)
                found[i] = _merged_moments(found[i], own) if i in found else own
        rows = []
        for i, m in found.items():
            for j in range(k):
                spread = math.sqrt(max(m[j, 3], 0.0)) * math.sqrt(max(m[j, 4], 0.0))
                rows.append((i, j, float(m[j, 5]) / spread if m[j, 0] > 1 and spread > 0 else None))
        i, j, c = zip(*rows) if rows else ((), (), ())
        arrays = [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(c, pa.float64())]
        yield pa.RecordBatch.from_arrays(arrays, names=["i", "j", "correlation"])

    plain = df.select(*[number(f"`{c}`").alias(f"_{n}") for n, c in enumerate(columns)])
    parts = plain.mapInArrow(partial, "i int, data binary").repartition("i")
    found = parts.mapInArrow(merge, "i int, j int, correlation double")
    # Every pair has a row, for an empty table too; both sides hold columns squared rows.
    place = F.col("id")
    pairs = df.sparkSession.range(k * k).select((place / k).cast("int").alias("i"), (place % k).cast("int").alias("j"))
    return pairs.join(found, ["i", "j"], "left")


def _named_pairs(found: DataFrame, columns: Sequence[str]) -> DataFrame:
    names = F.array(*map(F.lit, columns))
    return found.select(names[F.col("i")].alias("feature_1"), names[F.col("j")].alias("feature_2"), "correlation")


def pair_correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature_1, feature_2, correlation) for every unordered pair, each over its own complete rows; NaN counts as NULL."""
    return _named_pairs(_correlations(df, columns).where("i < j"), columns)


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature_1, feature_2, correlation) for every ordered pair, Pearson, pairwise complete."""
    same = F.when(F.col("i") == F.col("j"), 1.0).otherwise(F.col("correlation"))
    return _named_pairs(_correlations(df, columns).withColumn("correlation", same), columns)


def correlated_pairs(df: DataFrame, columns: Sequence[str], threshold: float = 0.8) -> DataFrame:
    """Pairs whose absolute correlation reaches `threshold`, strongest first; empty when there are none."""
    strength = F.abs("correlation")
    return (
        pair_correlations(df, columns)
        .select("feature_1", "feature_2", strength.alias("correlation"))
        .filter(F.col("correlation") >= threshold)
        .orderBy(F.desc("correlation"), "feature_1", "feature_2")
    )


def target_correlation(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """(feature, importance): absolute correlation of each numeric feature with the label."""
    found = per_column(df, columns, {"importance": lambda c: F.abs(F.corr(c, label))})
    return found.withColumnRenamed("column", "feature").orderBy(F.desc("importance"), "feature")


def box_stats(df: DataFrame, columns: Sequence[str], by: str) -> DataFrame:
    """(by, column, n, q1, median, q3, low_whisker, high_whisker), outliers left out.

    A whisker is the outermost value within 1.5 interquartile ranges of the box. `by` must have few
    distinct values: the box table is broadcast to the rows.
    """
    q = exact_quantiles(df, columns, [0.25, 0.5, 0.75], [by], bounded_groups=True).select(
        by,
        "column",
        "n",
        F.col("q0").alias("q1"),
        F.col("q1").alias("median"),
        F.col("q2").alias("q3"),
    )
    reach = (F.col("q3") - F.col("q1")) * F.lit(1.5)
    v = F.col("value")
    return (
        df.select(by, *[number(c).alias(c) for c in columns])
        .unpivot([by], list(columns), "column", "value")
        .join(F.broadcast(q), [by, "column"])
        .groupBy(by, "column")
        .agg(
            *[F.first(c).alias(c) for c in ("n", "q1", "median", "q3")],
            F.min(F.when(v >= F.col("q1") - reach, v)).alias("low_whisker"),
            F.max(F.when(v <= F.col("q3") + reach, v)).alias("high_whisker"),
        )
    )


def histogram(df: DataFrame, bins: Mapping[str, int]) -> DataFrame:
    """(column, bin, low, high, n): equal-width bins per column; the last one includes its upper edge.

    Empty bins have no row.
    """
    names = list(bins)
    limits = per_column(
        df,
        names,
        {"lo": lambda c: F.min(number(c)), "hi": lambda c: F.max(number(c)), "bins": lambda c: F.lit(bins[c])},
    )
    rows = (
        df.select(*[number(c).alias(c) for c in names])
        .unpivot([], names, "column", "value")
        .filter("value IS NOT NULL")
        .join(F.broadcast(limits), "column")
    )
    width = (F.col("hi") - F.col("lo")) / F.col("bins")
    slot = F.coalesce(F.floor(F.try_divide(F.col("value") - F.col("lo"), width)), F.lit(0))
    counted = (
        rows.withColumn("bin", F.least(slot, F.col("bins") - 1).cast("int"))
        .groupBy("column", "lo", "hi", "bins", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counted.select(
        "column",
        "bin",
        (F.col("lo") + width * F.col("bin")).alias("low"),
        (F.col("lo") + width * (F.col("bin") + 1)).alias("high"),
        "n",
    )


def null_patterns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(pattern, missing, n): one character per column, 1 where it is NULL."""
    flags = [F.col(f"`{c}`").isNull().cast("int") for c in columns]
    missing = flags[0]
    for f in flags[1:]:
        missing = missing + f
    return (
        df.select(F.concat(*[f.cast("string") for f in flags]).alias("pattern"), missing.alias("missing"))
        .groupBy("pattern", "missing")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def credit_line_years(df: DataFrame) -> DataFrame:
    """(year, n) of the earliest credit line; unreadable dates count under NULL."""
    year = F.year(credit_line_date(F.col("earliest_cr_line")))
    return df.groupBy(year.alias("year")).agg(F.count(F.lit(1)).alias("n"))


def table_shape(df: DataFrame) -> DataFrame:
    """(rows, columns)."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def schema_table(df: DataFrame) -> DataFrame:
    """(position, column, type, non_null): the schema with the number of values in each column."""
    types = F.create_map(*[x for f in df.schema for x in (F.lit(f.name), F.lit(f.dataType.simpleString()))])
    places = F.create_map(*[x for i, f in enumerate(df.schema) for x in (F.lit(f.name), F.lit(i))])
    counted = per_column(df, df.columns, {"non_null": lambda c: F.count(F.col(f"`{c}`"))})
    return counted.select(
        places[F.col("column")].alias("position"), "column", types[F.col("column")].alias("type"), "non_null"
    )
