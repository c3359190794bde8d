"""Reproducible splits, folds and samples from a hash of the row key.

No shuffle and no ordering is needed: membership depends on the row alone, so it survives
re-partitioning, appended rows and lost executors. Within every stratum the shares hold up to
sampling error; `exact_split` meets them to the row, at the price of two more reads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendframe.functions.cleaning import stable_hash
from lendframe.operators.lookup import attach
from lendframe.operators.ranking import running_totals
from lendframe.schema import ID
from lendframe.session import local_copy, materialise

SEED = 42


def split_column(key: str = ID, test_percent: int = 20, seed: int = SEED) -> Column:
    in_test = stable_hash(F.col(key), seed) % 100 < test_percent
    return F.when(in_test, F.lit("test")).otherwise(F.lit("train"))


def three_splits(
    key: str = ID, test_percent: int = 20, validation_percent: int = 20, seed: int = SEED
) -> Column:
    """train, validation or test; the test rows are those of `split_column`."""
    place = stable_hash(F.col(key), seed) % 100
    held = F.when(place < test_percent, "test").when(place < test_percent + validation_percent, "validation")
    return held.otherwise(F.lit("train"))


def fold_column(key: str = ID, folds: int = 5, seed: int = SEED) -> Column:
    return (stable_hash(F.col(key), seed) % folds).cast("int")


def with_split(df: DataFrame, key: str = ID, test_percent: int = 20, seed: int = SEED) -> DataFrame:
    return df.withColumn("split", split_column(key, test_percent, seed))


def exact_split(
    df: DataFrame, stratum: str, key: str = ID, test_percent: int = 20, seed: int = SEED, name: str = "split"
) -> DataFrame:
    """`df` with a split whose test part holds `test_percent` of every stratum, rounded half up, to the row.

    The test rows of a stratum are those first by (hash, key). Only the place of the cut is searched: a
    histogram of the upper 12 bits of the hash finds the slice that holds it, and just the rows of these
    slices, about one in 4,096, are ordered. Rows that share a key stay together, on the test side if the cut
    falls among them, so a quota is met exactly where keys are unique. Rows without a stratum are train;
    those without a key count as one key.
    """
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    rows = df.filter(F.col(stratum).isNotNull()).select(
        F.col(stratum).alias("_stratum"), text.alias("_key"), stable_hash(text, seed).alias("_hash")
    )
    slice_of = F.shiftright("_hash", 20)
    whole = Window.partitionBy("_stratum")
    slices = (
        rows.groupBy("_stratum", slice_of.alias("_slice"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumns(
            {
                "_upto": F.sum("n").over(whole.orderBy("_slice")),
                "_quota": F.expr(f"(sum(n) OVER (PARTITION BY _stratum) * {2 * test_percent} + 100) div 200"),
            }
        )
    )
    before = F.col("_upto") - F.col("n")
    cut = slices.filter((F.col("_upto") >= F.col("_quota")) & (before < F.col("_quota"))).select(
        "_stratum", "_slice", (F.col("_quota") - before).alias("_need")
    )
    cut = materialise(cut, "slices")
    small = local_copy(cut)
    near = attach(rows, small if small is not None else cut, "_stratum", small is not None)
    near = near.filter(slice_of == F.col("_slice")).groupBy("_stratum", "_need", "_hash", "_key").agg(F.count(F.lit(1)).alias("n"))
    near = materialise(near, "near-cut")
    hashes = near.groupBy("_stratum", "_need", "_hash").agg(F.sum("n").alias("n"))
    ranked = running_totals(hashes, "_hash", ["n"], ["_stratum"])
    before = F.col("n_upto") - F.col("n")
    at = ranked.filter((F.col("n_upto") >= F.col("_need")) & (before < F.col("_need"))).select(
        "_stratum", "_hash", (F.col("_need") - before).alias("_left")
    )
    # Different keys of one 32-bit hash within a stratum are few.
    equal = near.join(at, ["_stratum", "_hash"]).withColumn("_upto", F.sum("n").over(whole.orderBy("_key")))
    before = F.col("_upto") - F.col("n")
    last = equal.filter((F.col("_upto") >= F.col("_left")) & (before < F.col("_left"))).select(
        F.col("_stratum").alias(stratum), F.struct("_hash", "_key").alias("_last")
    )
    last = materialise(last, "cuts")
    small = local_copy(last)
    placed = attach(df, small if small is not None else last, stratum, small is not None)
    place = F.struct(stable_hash(text, seed).alias("_hash"), text.alias("_key"))
    side = F.when(place <= F.col("_last"), F.lit("test")).otherwise(F.lit("train"))
    return placed.withColumn(name, side).drop("_last")


def with_fold(df: DataFrame, key: str = ID, folds: int = 5, seed: int = SEED) -> DataFrame:
    return df.withColumn("fold", fold_column(key, folds, seed))


def sample_rows(df: DataFrame, n: int, key: str = ID, seed: int = SEED) -> DataFrame:
    """`n` rows in hash order: each task keeps its own top n, nothing is fully sorted."""
    h = stable_hash(F.col(key), seed)
    return df.withColumn("_h", h).orderBy("_h", key).limit(n).drop("_h")


def share(df: DataFrame, fraction: float, key: str = ID, seed: int = SEED) -> DataFrame:
    """Rows whose hash falls in the first `fraction` of the hash range; larger shares contain smaller."""
    return df.filter(stable_hash(F.col(key), seed) % 10000 < int(round(fraction * 10000)))


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """One row (pos, neg, scale_pos_weight) with weight neg / pos."""
    counts = df.agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    weight = F.try_divide(F.col("neg").cast("double"), F.col("pos").cast("double"))
    return counts.withColumn("scale_pos_weight", weight)


def with_class_weight(df: DataFrame, label: str = "label", name: str = "weight") -> DataFrame:
    """Row weight: neg / pos for the positive class, 1 for the other."""
    weight = class_weights(df, label).select("scale_pos_weight").scalar()
    return (
        df.withColumn("_w", weight)
        .withColumn(name, F.when(F.col(label) == 1, F.col("_w")).otherwise(F.lit(1.0)))
        .drop("_w")
    )
