"""Running totals and exact quantiles without a single-task sort.

A window with no partition key pulls the whole table into one task. Here the table is first
collapsed to distinct values (repeats of a hot value merge map-side), cut into ranges of about equal
size by approximate percentiles, summed inside each range in parallel, and shifted by the totals of
the ranges before it. Which range a value falls in never changes the result, only the balance.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def _small(df: DataFrame, bounded: bool) -> DataFrame:
    return F.broadcast(df) if bounded else df


def running_totals(
    hist: DataFrame,
    order_by: str,
    sums: Sequence[str],
    groups: Sequence[str] = (),
    descending: bool = False,
    bounded_groups: bool = False,
    ranges: int | None = None,
) -> DataFrame:
    """Add `<s>_upto` (running sum, own row included) and `<s>_total` for every `s` in `sums`.

    `hist` holds one row per (groups, order_by); group keys must not be NULL. Set `bounded_groups`
    only when the number of groups is fixed by the caller (a list of columns or of models): the
    per-group tables are then broadcast, otherwise Spark picks the join from measured sizes.
    """
    groups = list(groups)
    # As many ranges as shuffle partitions, so the ordering spreads over the whole cluster.
    ranges = ranges or max(2, int(hist.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # Reading every sum keeps the columns of this branch equal to the main one, so Spark plans the
    # histogram shuffle once and reuses it.
    used = sum((F.col(s) for s in sums[1:]), F.col(sums[0])) >= 0
    cuts = F.percentile_approx(
        F.when(used, F.col(order_by)), [i / ranges for i in range(1, ranges)], 1000
    ).alias("_cuts")
    if groups:
        keyed = hist.join(_small(hist.groupBy(*groups).agg(cuts), bounded_groups), groups)
    else:
        keyed = hist.withColumn("_cuts", hist.agg(cuts).scalar())
    # Never NULL: a nullable join key would push this expression down to the raw rows.
    place = F.size(F.filter("_cuts", lambda cut: cut < F.col(order_by)))
    keyed = keyed.withColumn("_range", F.coalesce(place, F.lit(0))).drop("_cuts")

    def ordered(name: str) -> Column:
        return F.col(name).desc() if descending else F.col(name).asc()

    whole = Window.partitionBy(*groups)
    before = whole.orderBy(ordered("_range")).rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        keyed.groupBy(*groups, "_range")
        .agg(*[F.sum(s).alias(f"_{s}") for s in sums])
        .select(
            *groups,
            "_range",
            *[F.coalesce(F.sum(f"_{s}").over(before), F.lit(0)).alias(f"_{s}") for s in sums],
            *[F.sum(f"_{s}").over(whole).alias(f"{s}_total") for s in sums],
        )
    )
    inside = (
        Window.partitionBy(*groups, "_range")
        .orderBy(ordered(order_by))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = keyed.withColumns({f"{s}_upto": F.sum(s).over(inside) for s in sums})
    return (
        local.join(_small(shifts, bounded_groups or not groups), [*groups, "_range"])
        .withColumns({f"{s}_upto": F.col(f"{s}_upto") + F.col(f"_{s}") for s in sums})
        .drop("_range", *[f"_{s}" for s in sums])
    )


def number(c: str) -> Column:
    """Column as double, NaN read as NULL."""
    return F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))


def value_histogram(
    df: DataFrame, columns: Sequence[str], groups: Sequence[str] = ()
) -> DataFrame:
    """(groups..., column, value, n): counts of the non-NULL values of several numeric columns."""
    groups = list(groups)
    long = df.select(*groups, *[number(c).alias(c) for c in columns]).unpivot(
        groups, list(columns), "column", "value"
    )
    keep = F.col("value").isNotNull()
    for g in groups:
        keep = keep & F.col(g).isNotNull()
    return long.filter(keep).groupBy(*groups, "column", "value").agg(F.count(F.lit(1)).alias("n"))


def quantiles_of(
    hist: DataFrame,
    probabilities: Sequence[float],
    groups: Sequence[str] = (),
    interpolate: bool = True,
    bounded_groups: bool = False,
) -> DataFrame:
    """(groups..., column, n, q0, q1, ...) from a `value_histogram`.

    `interpolate=True` averages linearly between neighbours (0.5 gives the usual median);
    False returns the lower of the two, always a value that occurs.
    """
    keys = [*groups, "column"]
    ranked = running_totals(
        hist, "value", ["n"], keys, bounded_groups=bounded_groups or not list(groups)
    )
    return _picked(ranked, probabilities, keys, interpolate)


def _picked(
    ranked: DataFrame, probabilities: Sequence[float], keys: Sequence[str], interpolate: bool
) -> DataFrame:
    """Quantiles from running counts: the first value whose count passes the wanted rank."""
    picks: list[Column] = []
    for i, p in enumerate(probabilities):
        rank = F.lit(float(p)) * (F.col("n_total") - 1)
        for tag, r in (("lo", F.floor(rank)), ("hi", F.ceil(rank))):
            picks.append(F.min(F.when(F.col("n_upto") > r, F.col("value"))).alias(f"_{tag}{i}"))
    found = ranked.groupBy(*keys).agg(F.max("n_total").alias("n"), *picks)
    out: list[Column] = []
    for i, p in enumerate(probabilities):
        lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        rank = F.lit(float(p)) * (F.col("n") - 1)
        exact = lo + (hi - lo) * (rank - F.floor(rank))
        out.append((exact if interpolate else lo).alias(f"q{i}"))
    return found.select(*keys, "n", *out)


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    groups: Sequence[str] = (),
    interpolate: bool = True,
    bounded_groups: bool = False,
    accuracy: int = 10000,
) -> DataFrame:
    """(groups..., column, n, q0, q1, ...): exact quantiles of several columns.

    NULL and NaN values and NULL group keys are left out. Without groups, or with few of them
    (`bounded_groups`), the table is read twice and almost nothing is shuffled: mergeable summaries
    first give, for each probability, a narrow bracket that holds its rank; the second read counts
    single values inside the brackets only and keeps count, minimum and maximum of everything
    between them. No task orders more than about 4 / accuracy of the rows, less where values repeat.

    With an unknown number of groups the value counts of `value_histogram` are ranked instead.
    """
    groups = list(groups)
    if groups and not bounded_groups:
        hist = value_histogram(df, columns, groups)
        return quantiles_of(hist, probabilities, groups, interpolate)
    clean = df.select(*groups, *[number(c).alias(c) for c in columns])
    for g in groups:
        clean = clean.filter(F.col(g).isNotNull())
    slack = 2.0 / accuracy
    wanted = [x for p in probabilities for x in (max(p - slack, 0.0), min(p + slack, 1.0))]
    sketch = [F.percentile_approx(c, wanted, accuracy).alias(c) for c in columns]
    bounds = (
        clean.groupBy(*groups)
        .agg(*sketch)
        .unpivot(groups, list(columns), "column", "_e")
        .select(*groups, "column", *[F.col("_e")[i].alias(f"_e{i}") for i in range(len(wanted))])
    )
    v = F.col("v")
    inside, slot = F.lit(False), F.lit(0)
    for i in range(0, len(wanted), 2):
        low, high = F.col(f"_e{i}"), F.col(f"_e{i + 1}")
        inside = inside | ((v >= low) & (v <= high))
        slot = slot + (v > low).cast("int") + (v > high).cast("int")
    # A slot that could be NULL would filter one side of the join below only, and the two sides would
    # no longer share their shuffle.
    never_null = F.coalesce(slot, F.lit(0))
    counted = (
        clean.unpivot(groups, list(columns), "column", "v")
        .filter(v.isNotNull())
        .join(F.broadcast(bounds), [*groups, "column"])
        .select(*groups, "column", "v", F.when(inside, v).alias("inner"), never_null.alias("slot"))
        .groupBy(*groups, "column", "slot", "inner")
        .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    )
    # A stretch between brackets is only ever entered at its first or last value.
    split = F.col("inner").isNull() & (F.col("n") > 1)
    one = F.lit(1).cast("bigint")
    rest = F.when(split, F.col("n") - 1).otherwise(F.col("n"))
    first = F.struct(F.col("lo").alias("value"), rest.alias("n"))
    last = F.struct(F.col("hi").alias("value"), one.alias("n"))
    steps = counted.select(
        *groups, "column", "slot", F.explode(F.when(split, F.array(first, last)).otherwise(F.array(first))).alias("s")
    ).select(*groups, "column", "slot", "s.value", "s.n")
    # Slots are in value order, so each one is summed on its own and shifted by those before it.
    keys = [*groups, "column"]
    inside_slot = (
        Window.partitionBy(*keys, "slot")
        .orderBy("value")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = steps.withColumn("_upto", F.sum("n").over(inside_slot))
    slots = Window.partitionBy(*keys)
    before = slots.orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        local.groupBy(*keys, "slot")
        .agg(F.max("_upto").alias("_all"))
        .select(
            *keys,
            "slot",
            F.coalesce(F.sum("_all").over(before), F.lit(0)).alias("_shift"),
            F.sum("_all").over(slots).alias("n_total"),
        )
    )
    ranked = local.join(F.broadcast(shifts), [*keys, "slot"]).select(
        *keys, "value", (F.col("_upto") + F.col("_shift")).alias("n_upto"), "n_total"
    )
    return _picked(ranked, probabilities, [*groups, "column"], interpolate)


def approx_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    groups: Sequence[str] = (),
    accuracy: int = 10000,
) -> DataFrame:
    """As `exact_quantiles`, from mergeable summaries: one shuffle, rank error at most 1/accuracy.

    An all-NULL column gives NULL quantiles instead of an error.
    """
    groups = list(groups)
    probs = [float(p) for p in probabilities]
    wide = df.groupBy(*groups).agg(
        *[F.percentile_approx(c, probs, accuracy).alias(c) for c in columns]
    )
    long = wide.unpivot(groups, list(columns), "column", "_q")
    return long.select(
        *groups, "column", *[F.col("_q")[i].alias(f"q{i}") for i in range(len(probs))]
    )


def quantile_cuts(df: DataFrame, columns: Sequence[str], bins: int) -> DataFrame:
    """(feature, cut1, cut2, ...): the bins - 1 exact quantiles that cut each column into equal shares."""
    found = exact_quantiles(df, columns, [i / bins for i in range(1, bins)])
    return found.select(
        F.col("column").alias("feature"), *[F.col(f"q{i - 1}").alias(f"cut{i}") for i in range(1, bins)]
    )


def binned(
    df: DataFrame,
    keep: Sequence[str],
    texts: Sequence[str],
    numbers: Sequence[str],
    cuts: DataFrame | None,
    bins: int,
) -> DataFrame:
    """(keep..., feature, bin): texts are their own bins, numbers count the cuts below them."""
    keep = list(keep)
    parts = []
    if texts:
        wide = df.select(*keep, *[F.col(c).cast("string").alias(c) for c in texts])
        parts.append(wide.unpivot(keep, list(texts), "feature", "bin"))
    if numbers:
        below = F.lit(0)
        for i in range(1, bins):
            below = below + (F.col("value") > F.col(f"cut{i}")).cast("int")
        long = df.select(*keep, *[number(c).alias(c) for c in numbers]).unpivot(
            keep, list(numbers), "feature", "value"
        )
        placed = long.join(F.broadcast(cuts), "feature", "left")
        parts.append(placed.select(*keep, "feature", below.cast("string").alias("bin")))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
