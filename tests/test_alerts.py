"""Window alerts on streams: late rows, restarts, and plain Python."""

import datetime as dt
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lendframe.operators.drift import FLOOR
from lendframe.streaming import alerts

LAYOUT = "id long, ts timestamp, value double, kind string, status string"
DAY = dt.datetime(2024, 5, 1, tzinfo=dt.timezone.utc)


def event(i, hours, value, kind, status="ok"):
    return i, DAY + dt.timedelta(hours=hours), value, kind, status


@pytest.fixture(scope="module")
def known(spark):
    source = random.Random(1)
    rows = [event(i, 0, source.choice([None, 1.0, 2.0, 3.0, 5.0, 8.0]), source.choice(["a", "b", None])) for i in range(400)]
    return spark.createDataFrame(rows, LAYOUT).cache()


def plain(rows, watched):
    """{window start: (rows, error rate, psi per column)} by counting."""
    out = {}
    day = lambda t: t.replace(hour=0, minute=0, second=0, microsecond=0)
    for start in sorted({day(r[1]) for r in rows if r[1]}):
        mine = [r for r in rows if r[1] and day(r[1]) == start]
        found = []
        for w, at in zip(watched, (2, 3)):
            def bin_of(v, w=w):
                if v is None or v != v:
                    return 0
                if w.cuts is not None:
                    return 1 + sum(v > c for c in w.cuts)
                return w.values.index(v) + 1 if v in w.values else w.bins - 1

            counts = Counter(bin_of(r[at]) for r in mine)
            pairs = [(max(s, FLOOR), max(counts[i] / len(mine), FLOOR)) for i, s in enumerate(w.shares)]
            found.append(sum((q - p) * math.log(q / p) for p, q in pairs))
        out[start] = (len(mine), sum(r[4] == "bad" for r in mine) / len(mine), *found)
    return out


def measured(df, watched, delay="1 hour"):
    return alerts.monitor(df, watched, F.col("status") == "bad", delay=delay)


def as_python(df):
    rows = df.withColumn("at", F.unix_seconds("window_start")).collect()
    return {dt.datetime.fromtimestamp(r["at"], dt.timezone.utc): (r["rows"], r.error_rate, r.psi_value, r.psi_kind) for r in rows}


def close(got, want):
    assert set(got) == set(want)
    for k in want:
        assert got[k] == pytest.approx(want[k], abs=1e-9), k


def made(n, days, seed):
    source = random.Random(seed)
    return [
        event(i, source.uniform(0, 24 * days), source.choice([None, math.nan, 1.0, 4.0, 100.0]), source.choice(["a", "b", "new", None]),
              source.choice(["ok"] * 9 + ["bad"]))
        for i in range(n)
    ]


def test_windows_of_a_table_and_its_baseline(spark, known):
    watched = alerts.baseline(known, ["kind"], ["value"])
    assert [w.name for w in watched] == ["value", "kind"] and all(sum(w.shares) == pytest.approx(1) for w in watched)
    rows = [*made(500, 4, 3), (999, None, 1.0, "a", "bad")]
    df = spark.createDataFrame(rows, LAYOUT)
    close(as_python(measured(df, watched)), plain(rows, watched))
    same = measured(known, watched).first()
    assert same.psi_value == pytest.approx(0) and same.psi_kind == pytest.approx(0) and same.alerts == []
    assert set(measured(df, watched).first().alerts) == {"error_rate", "value", "kind"}
    assert measured(df.limit(0), watched).count() == 0 and alerts.baseline(known) == []
    with pytest.raises(ValueError, match="values"):
        alerts.baseline(spark.range(2_000).select(F.col("id").alias("kind")), ["kind"])


def test_a_stream_equals_the_table_after_late_rows_and_a_restart(spark, known, tmp_path):
    watched = alerts.baseline(known, ["kind"], ["value"])
    folder, out, checkpoint = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/c"
    rows = made(300, 3, 8)

    def arrive(part):
        spark.createDataFrame(part, LAYOUT).coalesce(1).write.mode("append").parquet(folder)

    def run():
        source = spark.readStream.schema(LAYOUT).option("maxFilesPerTrigger", 1).parquet(folder)
        alerts.alert_stream(measured(source, watched, "12 hours"), out, checkpoint).awaitTermination(120)
        return as_python(alerts.newest_windows(spark, out))

    rows.sort(key=lambda r: r[1])
    arrive(rows[:150])
    first = run()
    close(first, plain(rows[:150], watched))
    # The query starts anew from its checkpoint; 150 later rows and some that are late but within the delay.
    newest = rows[149][1]
    late = [(1_000 + i, newest - dt.timedelta(hours=3), 4.0, "new", "bad") for i in range(7)]
    arrive(late)
    arrive(rows[150:])
    got = run()
    close(got, plain(rows + late, watched))
    assert run() == got
    # Far beyond the delay: the closed window stays as it was.
    arrive([(2_000, DAY + dt.timedelta(minutes=1), 1.0, "a", "bad")])
    arrive([(2_001, DAY + dt.timedelta(days=9), 1.0, "a", "bad")])
    after = run()
    assert {k: after[k] for k in got} == got and after[DAY + dt.timedelta(days=9)][:2] == (1, 1.0)
