"""Information of numeric columns about a class, from distances to the nearest neighbours.

For every row the distance to its k-th neighbour of the same class is compared with the number of rows
of any class that lie closer. Columns are first collapsed to distinct values per class, so a hot value is one
row. Distinct values are cut into ranges that each task handles on its own; what a range needs from its
neighbours is at most k values on either side, and only those are exchanged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendframe.operators.ranking import number, running_totals, value_histogram
from lendframe.session import materialise


def digamma(n: Column) -> Column:
    """Digamma of a number of at least 1, to about 1e-12."""
    x = n.cast("double")
    y = x + 10.0
    square = y * y
    series = (1.0 / 12 - (1.0 / 120 - (1.0 / 252 - (1.0 / 240) / square) / square) / square) / square
    below = sum((1.0 / (x + float(i)) for i in range(1, 10)), 1.0 / x)
    return F.ln(y) - 0.5 / y - series - below


def _ranged(hist: DataFrame, groups: Sequence[str], ranges: int) -> DataFrame:
    """`hist` with `_range`, numbering ranges of about equal size in the order of `value` within a group."""
    cuts = hist.groupBy(*groups).agg(
        F.percentile_approx("value", [i / ranges for i in range(1, ranges)], 1000).alias("_cuts")
    )
    place = F.size(F.filter("_cuts", lambda cut: cut < F.col("value")))
    placed = hist.join(cuts, list(groups)).withColumn("_range", place).drop("_cuts")
    # Written once: both readers below must see the same ranges.
    return materialise(placed, "ranges")


def _with_borders(ranged: DataFrame, groups: Sequence[str], k: int) -> DataFrame:
    """All rows as `_own`, and per range copies of the k values before and after it."""
    inside = Window.partitionBy(*groups, "_range")
    edges = ranged.withColumns(
        {
            "_first": F.row_number().over(inside.orderBy("value")),
            "_last": F.row_number().over(inside.orderBy(F.desc("value"))),
        }
    ).filter((F.col("_first") <= k) | (F.col("_last") <= k))
    # At most 2 k rows per range, so a group's edges are as many as there are ranges, not as its rows.
    along = Window.partitionBy(*groups).orderBy("value")
    cell = F.struct("value", "n")
    near = edges.select(
        *groups,
        "_range",
        F.when(F.col("_first") == 1, F.collect_list(cell).over(along.rowsBetween(-k, -1))).alias("_before"),
        F.when(F.col("_last") == 1, F.collect_list(cell).over(along.rowsBetween(1, k))).alias("_after"),
    )
    none = F.array().cast("array<struct<value:double,n:bigint>>")
    copies = near.select(
        *groups,
        "_range",
        F.explode(F.concat(F.coalesce("_before", none), F.coalesce("_after", none))).alias("c"),
    ).select(*groups, "_range", "c.value", "c.n", F.lit(False).alias("_own"))
    return ranged.withColumn("_own", F.lit(True)).select(*copies.columns).unionByName(copies)


def kth_neighbours(hist: DataFrame, groups: Sequence[str], k: int = 3, ranges: int | None = None) -> DataFrame:
    """(groups..., value, n, k, distance, low, high) for every row of `hist` (groups..., value, n).

    `distance` is that from one of the n equal values to its k-th neighbour in the group, its copies included;
    groups of k values or fewer use one neighbour less than they have, groups of one value give no row.
    `low` and `high` bound the open interval of values that are closer. Neither key nor value may be NULL.
    """
    groups = list(groups)
    ranges = ranges or max(2, int(hist.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    sizes = hist.groupBy(*groups).agg(F.sum("n").alias("_size"))
    ranged = _ranged(hist.select(*groups, "value", F.col("n").cast("bigint").alias("n")), groups, ranges)
    order = Window.partitionBy(*groups, "_range").orderBy("value")
    cell = F.struct("value", "n")
    rows = (
        _with_borders(ranged, groups, k)
        .withColumn(
            "_near",
            F.concat(
                F.collect_list(cell).over(order.rowsBetween(-k, -1)), F.collect_list(cell).over(order.rowsBetween(1, k))
            ),
        )
        .filter("_own")
        .join(sizes, groups)
        .filter("_size > 1")
        .withColumn("k", F.least(F.lit(k), F.col("_size") - 1).cast("bigint"))
    )
    gap = F.transform(
        "_near", lambda c: F.struct(F.abs(c["value"] - F.col("value")).alias("gap"), c["value"].alias("value"), c["n"].alias("n"))
    )
    rows = rows.withColumn("_near", gap)

    def reached(c: Column) -> Column:
        closer = F.filter("_near", lambda o: o["gap"] <= c["gap"])
        return F.aggregate(closer, F.col("n") - 1, lambda total, o: total + o["n"]) >= F.col("k")

    enough = F.array_min(F.transform(F.filter("_near", reached), lambda c: c["gap"]))
    rows = rows.withColumn("distance", F.when(F.col("n") > F.col("k"), F.lit(0.0)).otherwise(enough))
    # A neighbour at just that distance bounds the interval itself, whatever v + d rounds to.
    at = F.transform(F.filter("_near", lambda c: c["gap"] == F.col("distance")), lambda c: c["value"])
    value = F.col("value")
    low = F.coalesce(F.array_max(F.filter(at, lambda v: v < value)), value - F.col("distance"))
    high = F.coalesce(F.array_min(F.filter(at, lambda v: v > value)), value + F.col("distance"))
    return rows.select(*groups, "value", "n", "k", "distance", low.alias("low"), high.alias("high"))


def neighbour_information(
    df: DataFrame, label: str, numbers: Sequence[str], k: int = 3, ranges: int | None = None
) -> DataFrame:
    """(feature, importance): information in nats each number carries about the class, strongest first.

    Rows without a label are left out, a missing number counts as 0, classes of a single row are ignored.
    Where more than k rows of a class share a value, the distance is 0 and their count takes the
    place of k, so columns that are partly or wholly discrete are estimated as well. Never below 0. Equal
    results are in the order of the names; a table without rows gives none.
    """
    filled = df.filter(F.col(label).isNotNull()).select(
        F.col(label).alias("_class"), *[F.coalesce(number(c), F.lit(0.0)).alias(c) for c in numbers]
    )
    hist = materialise(value_histogram(filled, numbers, ["_class"]), "values")
    near = materialise(kth_neighbours(hist, ["column", "_class"], k, ranges), "neighbours")
    # Counts below and up to a place, for all values and all interval ends in one ordering.
    places = (
        near.select("column", "value", "n")
        .unionByName(near.select("column", F.col("low").alias("value"), F.lit(0).cast("bigint").alias("n")))
        .unionByName(near.select("column", F.col("high").alias("value"), F.lit(0).cast("bigint").alias("n")))
        .groupBy("column", "value")
        .agg(F.sum("n").alias("n"))
    )
    ranked = materialise(running_totals(places, "value", ["n"], ["column"], bounded_groups=True, ranges=ranges), "ranks")
    upto = ranked.select("column", F.col("value").alias("low"), F.col("n_upto").alias("_low_upto"), F.col("n").alias("_low_n"))
    below = ranked.select("column", F.col("value").alias("high"), (F.col("n_upto") - F.col("n")).alias("_high_below"))
    # At distance 0 both ends are the value itself, and its own rows are what is counted.
    closer = F.when(F.col("distance") == 0, F.col("_low_n")).otherwise(F.col("_high_below") - F.col("_low_upto"))
    counted = near.join(upto, ["column", "low"]).join(below, ["column", "high"]).select(
        "column",
        "_class",
        "n",
        F.when(F.col("distance") == 0, F.col("n")).otherwise(F.col("k")).alias("_k"),
        closer.alias("_closer"),
    )
    by_class = counted.groupBy("column", "_class").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * (digamma(F.col("_k")) - digamma(F.col("_closer")))).alias("_s")
    )
    by_column = by_class.groupBy("column").agg(
        F.sum("n").alias("n"), F.sum(F.col("_s") - F.col("n") * digamma(F.col("n"))).alias("_s")
    )
    gain = F.greatest(F.lit(0.0), digamma(F.col("n")) + F.col("_s") / F.col("n"))
    return by_column.select(F.col("column").alias("feature"), gain.alias("importance")).orderBy(
        F.desc("importance"), "feature"
    )
