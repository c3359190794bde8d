import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendframe.operators import sketches, split


def place(key, seed=42):
    text = "" if key is None else str(key)
    return int(hashlib.md5(f"{text}:{seed}".encode()).hexdigest()[:8], 16), text


@pytest.mark.parametrize("percent", [0, 1, 20, 50, 100])
def test_exact_split_equals_sorting_every_stratum(spark, percent):
    rows = [(i, "abc"[min(i % 7, 2)]) for i in range(3_001)] + [(i, None) for i in range(5_000, 5_010)] + [(9_000, "single")]
    df = spark.createDataFrame(rows, "loan_id long, kind string").repartition(5)
    got = {r["loan_id"]: r["split"] for r in split.exact_split(df, "kind", test_percent=percent).collect()}
    assert len(got) == len(rows)
    for kind in ("a", "b", "c", "single"):
        keys = sorted((i for i, k in rows if k == kind), key=place)
        quota = (len(keys) * percent * 2 + 100) // 200
        assert [got[i] for i in keys] == ["test"] * quota + ["train"] * (len(keys) - quota)
    assert {got[i] for i in range(5_000, 5_010)} == {"train"}


def test_exact_split_keeps_rows_of_a_key_together(spark):
    rows = [(7, "x")] * 500 + [(None, "x")] * 200 + [(i, "x") for i in range(100, 400)]
    df = spark.createDataFrame(rows, "loan_id long, kind string")
    found = split.exact_split(df, "kind").collect()
    sides = {}
    for r in found:
        sides.setdefault(r["loan_id"], set()).add(r["split"])
    assert len(found) == len(rows) and all(len(s) == 1 for s in sides.values())
    held, seen = Counter(i for i, _ in rows), 0
    for key in sorted(held, key=place):
        assert sides[key] == ({"test"} if seen < 200 else {"train"})
        seen += held[key]
    assert split.exact_split(df.limit(0), "kind").count() == 0


def days(spark):
    random = np.random.default_rng(3)
    rows = [
        (int(d), "ab"[int(g)], None if i % 11 == 0 else float(x), None, f"t{int(x * 100)}")
        for i, (d, g, x) in enumerate(zip(random.integers(0, 30, 20_000), random.integers(0, 2, 20_000), random.normal(size=20_000)))
    ]
    df = spark.createDataFrame(rows, "d int, g string, x double, nothing double, t string")
    return df, F.date_add(F.lit("2024-01-01").cast("date"), F.col("d"))


def test_merged_sketches_are_near_the_whole(spark, tmp_path):
    df, day = days(spark)
    sketches.store(sketches.sketched(df, day, ["x", "nothing"], ["t"], ["g"]), f"{tmp_path}/s")
    table = sketches.stored(spark, f"{tmp_path}/s")
    assert table.count() == 30 * 2 * 3
    points = [0.0, 0.1, 0.5, 0.9, 1.0]
    for by in ([], ["g"]):
        for r in sketches.estimates(sketches.merged(table, by), points).collect():
            rows = df.filter(F.col("g") == r["g"]) if by else df
            assert r["rows"] == rows.count()
            values = sorted(v[0] for v in rows.select(r["column"]).collect() if v[0] is not None)
            assert r["filled"] == len(values)
            assert r["n_distinct"] == pytest.approx(len(set(values)), rel=0.065, abs=0)
            if r["column"] != "x":
                assert r["values"] is None
                continue
            assert (r["values"][0], r["values"][-1]) == (values[0], values[-1])
            ranks = [np.searchsorted(values, v) / len(values) for v in r["values"]]
            assert ranks == pytest.approx(points, abs=0.01)


def test_a_day_written_anew_replaces_itself(spark, tmp_path):
    df, day = days(spark)
    path = f"{tmp_path}/s"
    sketches.store(sketches.sketched(df, day, ["x"]), path)
    sketches.store(sketches.sketched(df.filter("d = 3").limit(5), day, ["x"]), path)
    held = {r["day"].day: r["rows"] for r in sketches.stored(spark, path, "2024-01-03", "2024-01-05").collect()}
    want = Counter(r["d"] for r in df.select("d").collect())
    assert held == {3: want[2], 4: 5, 5: want[4]}
    empty = sketches.estimates(sketches.merged(sketches.sketched(df.limit(0), day, ["x"])), [0.5])
    assert empty.collect() == []
