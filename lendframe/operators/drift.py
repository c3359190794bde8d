"""Population-stability index between two tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendframe.operators.ranking import binned, quantile_cuts
from lendframe.schema import DRIFT_ALERT

# Fixed value: smallest share used in the index, so that an empty bin stays finite.
FLOOR = 1e-6
MISSING = "(missing)"


def stability_index(
    expected: DataFrame,
    actual: DataFrame,
    texts: Sequence[str] = (),
    numbers: Sequence[str] = (),
    bins: int = 10,
    alert: float = DRIFT_ALERT,
) -> DataFrame:
    """(feature, psi, alert): sum over bins of (q - p) ln(q / p).

    Numbers are cut at the quantiles of `expected`; NULL is a bin of its own. Both tables are counted
    in one aggregate; every row has one bin per feature, so the shares need only the two row counts.
    """

    def side(df: DataFrame, is_actual: bool) -> DataFrame:
        return df.select(F.lit(is_actual).alias("_actual"), *texts, *numbers)

    rows = side(expected, False).unionByName(side(actual, True))
    cuts = quantile_cuts(expected, numbers, bins) if numbers else None
    cells = (
        binned(rows, ["_actual"], texts, numbers, cuts, bins)
        .groupBy("feature", F.coalesce("bin", F.lit(MISSING)).alias("bin"))
        .agg(
            F.count_if(~F.col("_actual")).cast("double").alias("e"),
            F.count_if(F.col("_actual")).cast("double").alias("a"),
        )
    )
    count = F.count(F.lit(1)).cast("double")
    cells = cells.withColumns(
        {"_e": expected.agg(count).scalar(), "_a": actual.agg(count).scalar()}
    )
    p = F.greatest(F.try_divide("e", "_e"), F.lit(FLOOR))
    q = F.greatest(F.try_divide("a", "_a"), F.lit(FLOOR))
    return (
        cells.groupBy("feature")
        .agg(F.sum((q - p) * F.ln(q / p)).alias("psi"))
        .withColumn("alert", F.col("psi") > alert)
    )
