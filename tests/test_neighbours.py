import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendframe.operators.neighbours import digamma, kth_neighbours, neighbour_information


def psi(n):
    return -0.57721566490153286 + sum(1 / i for i in range(1, n))


def brute_force(values, classes, k):
    """Every distance between all rows."""
    values, classes = np.array(values, float), np.array(classes)
    kept = np.array([np.sum(classes == c) > 1 for c in classes])
    values, classes = values[kept], classes[kept]
    total = 0.0
    for i in range(len(values)):
        mates = values[(classes == classes[i]) & (np.arange(len(values)) != i)]
        use = min(k, len(mates))
        distance = np.sort(np.abs(mates - values[i]))[use - 1]
        if distance == 0:
            use, closer = 1 + np.sum(mates == values[i]), np.sum(values == values[i])
        else:
            closer = np.sum(np.abs(values - values[i]) < distance)
        total += psi(use) - psi(len(mates) + 1) - psi(closer)
    return max(0.0, psi(len(values)) + total / len(values))


def test_digamma(spark):
    points = [1, 2, 3, 10, 1000]
    got = spark.createDataFrame([(p,) for p in points], "n long").select(digamma(F.col("n"))).collect()
    assert [r[0] for r in got] == pytest.approx([psi(p) for p in points], abs=1e-11)


@pytest.mark.parametrize("ranges", [2, 7, 60])
def test_information_equals_brute_force_with_ties(spark, ranges):
    """Values on a grid of 1/8, so that distances are exact and many are equal."""
    random = np.random.default_rng(5)
    label = random.integers(0, 3, 2_000)
    columns = {
        "shifted": np.round((random.normal(size=2_000) + label) * 64) / 64,
        "noise": np.round(random.normal(size=2_000) * 4096) / 4096,
        "coarse": np.minimum(random.integers(0, 5, 2_000), label + 2),
        "constant": np.zeros(2_000),
        "hot": np.where(random.random(2_000) < 0.4, 7.0, np.round(random.random(2_000) * 1024) / 8 + label),
    }
    rows = [(int(c), *[float(v[i]) for v in columns.values()]) for i, c in enumerate(label)]
    df = spark.createDataFrame(rows, "label int, " + ", ".join(f"{c} double" for c in columns)).repartition(6)
    got = {r["feature"]: r["importance"] for r in neighbour_information(df, "label", list(columns), 3, ranges).collect()}
    want = {c: brute_force(v, label, 3) for c, v in columns.items()}
    assert got == pytest.approx(want, abs=1e-9)
    assert want["shifted"] > 0.2 > 0.05 > want["noise"]


@pytest.mark.parametrize("ranges", [2, 5, 40])
def test_neighbours_across_ranges_of_few_values(spark, ranges):
    values = [0.0, 1.0, 1.5, 4.0, 4.0, 9.0, 9.5, 20.0, 21.0, 21.25, 30.0]
    hist = [("a", v, values.count(v)) for v in sorted(set(values))] + [("b", 1.0, 1), ("b", 3.0, 1), ("c", 5.0, 1)]
    df = spark.createDataFrame(hist, "g string, value double, n long")
    found = {(r["g"], r["value"]): r["distance"] for r in kth_neighbours(df, ["g"], 3, ranges).collect()}
    for v in set(values):
        others = list(values)
        others.remove(v)
        assert found.pop(("a", v)) == sorted(abs(o - v) for o in others)[2]
    assert found == {("b", 1.0): 2.0, ("b", 3.0): 2.0}


def test_odd_rows(spark):
    layout = "label int, x double"
    assert neighbour_information(spark.createDataFrame([], layout), "label", ["x"]).collect() == []
    single = spark.createDataFrame([(0, 1.0), (1, 2.0)], layout)
    assert neighbour_information(single, "label", ["x"]).collect() == []
    rows = [(0, None), (0, math.nan), (0, 0.0), (1, 5.0), (1, 6.0), (1, 7.0), (None, 3.0), (2, 9.0)]
    got = neighbour_information(spark.createDataFrame(rows, layout), "label", ["x"]).first()
    assert got["importance"] == pytest.approx(brute_force([0, 0, 0, 5, 6, 7], [0, 0, 0, 1, 1, 1], 3), abs=1e-9)
