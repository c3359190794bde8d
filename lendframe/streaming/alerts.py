"""Drift and error-rate alerts per event-time window, on a stream or a table.

A baseline table fixes the bins of every watched column. Per window the stream keeps one row of state: how many rows
fell into each bin, and how many were errors. The population-stability index against the baseline and the error rate
are expressions over these counts, so a window costs the same state whatever its rows.

Windows are written whenever they change, each micro-batch to a folder of its own, so a repeated batch replaces
itself; of every window the newest row counts. Rows later than the watermark's delay no longer change their window.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lendframe.operators.drift import FLOOR
from lendframe.operators.ranking import number, quantile_cuts
from lendframe.schema import DRIFT_ALERT

# Fixed value: share of errors above which a window is reported.
ERROR_ALERT = 0.01
MOST_VALUES = 1_000  # of a watched text column; its bins are state of every window


@dataclass(frozen=True)
class Watched:
    """A column with its bins: one for missing values, then numbers by cuts or texts by value; last, unseen texts."""

    name: str
    cuts: tuple[float, ...] | None
    values: tuple[str, ...] = ()
    shares: tuple[float, ...] = ()

    @property
    def bins(self) -> int:
        return len(self.values if self.cuts is None else self.cuts) + 2

    def bin(self) -> Column:
        if self.cuts is not None:
            v = number(self.name)
            below = sum(((v > cut).cast("int") for cut in self.cuts), F.lit(1))
        else:
            v = F.col(self.name).cast("string")
            at = F.array_position(F.array(*map(F.lit, self.values)).cast("array<string>"), v)
            below = F.when(at > 0, at.cast("int")).otherwise(self.bins - 1)
        return F.when(v.isNull(), 0).otherwise(below)

    def counts(self) -> Column:
        own = self.bin()
        return F.array(*[F.count_if(own == i) for i in range(self.bins)])

    def index(self, counts: Column, n: Column) -> Column:
        """Sum over bins of (q - p) ln(q / p)."""
        total = F.lit(0.0)
        for i, share in enumerate(self.shares):
            p = max(share, FLOOR)
            q = F.greatest(counts[i] / n, F.lit(FLOOR))
            total = total + (q - p) * F.ln(q / p)
        return total


def baseline(df: DataFrame, texts: Sequence[str] = (), numbers: Sequence[str] = (), bins: int = 10) -> list[Watched]:
    """Bins and their shares from a table: numbers are cut at its exact quantiles, texts by its values."""
    watched: list[Watched] = []
    if numbers:
        found = {r["feature"]: r for r in quantile_cuts(df, numbers, bins).collect()}
        for c in numbers:
            cuts = {found[c][f"cut{i}"] for i in range(1, bins)} if c in found else set()
            watched.append(Watched(c, tuple(sorted(v for v in cuts if v is not None))))
    for c in texts:
        rows = df.select(F.col(c).cast("string").alias(c)).where(F.col(c).isNotNull()).distinct().limit(MOST_VALUES + 1)
        values = sorted(r[0] for r in rows.collect())
        if len(values) > MOST_VALUES:
            raise ValueError(f"{c} has more than {MOST_VALUES} values: too many to keep per window")
        watched.append(Watched(c, None, tuple(values)))
    if not watched:
        return []
    row = df.agg(F.count(F.lit(1)).alias("_n"), *[w.counts().alias(w.name) for w in watched]).first()
    n = row["_n"] or 1
    return [Watched(w.name, w.cuts, w.values, tuple(k / n for k in row[w.name])) for w in watched]


def monitor(
    rows: DataFrame,
    watched: Sequence[Watched],
    is_error: Column,
    time: str = "ts",
    length: str = "1 day",
    delay: str = "1 hour",
    drift_alert: float = DRIFT_ALERT,
    error_alert: float = ERROR_ALERT,
) -> DataFrame:
    """(window_start, rows, error_rate, psi per column, alerts) per window; the same plan for tables and streams.

    `alerts` lists `error_rate` and the columns whose index is above its limit. Rows without a time are left out.
    """
    if dict(rows.dtypes)[time] == "timestamp_ntz":
        # A time without a zone is read as UTC, whatever the session's zone.
        since = f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', {time})"
        rows = rows.withColumn(time, F.expr(f"timestamp_micros({since})"))
    counted = (
        rows.withWatermark(time, delay)
        .groupBy(F.window(time, length).alias("_window"))
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.coalesce(is_error, F.lit(False))).alias("_errors"),
            *[w.counts().alias(f"_{w.name}") for w in watched],
        )
    )
    n = F.col("rows")
    measured = counted.select(
        F.col("_window.start").alias("window_start"),
        "rows",
        (F.col("_errors") / n).alias("error_rate"),
        *[w.index(F.col(f"_{w.name}"), n).alias(f"psi_{w.name}") for w in watched],
    )
    raised = [F.when(F.col("error_rate") > error_alert, F.lit("error_rate"))]
    raised += [F.when(F.col(f"psi_{w.name}") > drift_alert, F.lit(w.name)) for w in watched]
    return measured.withColumn("alerts", F.array_compact(F.array(*raised)))


def alert_stream(measured: DataFrame, out: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Write the windows of a `monitor` stream that changed, batch by batch."""

    def replace(batch: DataFrame, number_: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number_}")

    writer = measured.writeStream.outputMode("update").foreachBatch(replace).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def newest_windows(spark: SparkSession, out: str) -> DataFrame:
    """Every window once, as it was last written."""
    written = spark.read.parquet(out)
    columns = [c for c in written.columns if c != "batch"]
    newest = written.groupBy("window_start").agg(F.max_by(F.struct(*columns), "batch").alias("w"))
    return newest.select("w.*")
