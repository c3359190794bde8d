import numpy as np
import pandas as pd
import pytest

from lendframe.operators.ranking import (
    approx_quantiles,
    exact_quantiles,
    quantiles_of,
    running_totals,
    value_histogram,
)

PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]


def draws(n, seed=0):
    r = np.random.default_rng(seed)
    hot = np.where(r.random(n) < 0.4, 7.0, r.normal(0, 100, n))
    return {
        "spread": r.normal(0, 1, n),
        "hot": hot,
        "few": r.integers(0, 4, n).astype(float),
    }


@pytest.mark.parametrize("n", [1, 2, 3, 6, 7, 50, 20011])
def test_exact_quantiles_equal_numpy(spark, n):
    data = draws(n, n)
    df = spark.createDataFrame(pd.DataFrame(data))
    rows = {r["column"]: r for r in exact_quantiles(df, list(data), PROBS).collect()}
    lower = {r["column"]: r for r in exact_quantiles(df, list(data), PROBS, interpolate=False).collect()}
    for c, v in data.items():
        assert rows[c]["n"] == n
        for i, p in enumerate(PROBS):
            assert rows[c][f"q{i}"] == pytest.approx(np.quantile(v, p), abs=1e-9)
            assert lower[c][f"q{i}"] == np.quantile(v, p, method="lower")


def test_grouped_quantiles_agree_whether_groups_are_bounded_or_not(spark):
    n = 5000
    data = pd.DataFrame(draws(n, 5))
    data["g"] = np.where(np.arange(n) % 3 == 0, "big", (np.arange(n) % 40).astype(str))
    df = spark.createDataFrame(data)
    want = data.groupby("g")[["spread", "hot"]].median()
    for bounded in (True, False):
        got = exact_quantiles(df, ["spread", "hot"], [0.5], ["g"], bounded_groups=bounded).collect()
        assert len(got) == 2 * len(want)
        for r in got:
            assert r["q0"] == pytest.approx(want.loc[r["g"], r["column"]], abs=1e-9)


def test_nulls_nans_and_null_groups_are_left_out(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", None), ("a", float("nan")), ("a", 3.0), (None, 9.0), ("b", None)], "g string, v double"
    )
    assert [tuple(r) for r in exact_quantiles(df, ["v"], [0.5]).collect()] == [("v", 3, 3.0)]
    for bounded in (True, False):
        got = exact_quantiles(df, ["v"], [0.5], ["g"], bounded_groups=bounded).collect()
        assert [tuple(r) for r in got] == [("a", "v", 2, 2.0)]


def test_histogram_route_equals_bracket_route(spark):
    df = spark.createDataFrame(pd.DataFrame(draws(3000, 9)))
    a = quantiles_of(value_histogram(df, ["spread", "few"]), PROBS).orderBy("column").collect()
    b = exact_quantiles(df, ["spread", "few"], PROBS).orderBy("column").collect()
    assert a == b


def test_approximate_median_is_a_value_of_the_group_and_null_for_no_values(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 2.0), (1, 4.0), (1, 8.0), (2, None)], "g int, v double")
    got = {r["g"]: r["q0"] for r in approx_quantiles(df, ["v"], [0.5], ["g"]).collect()}
    assert got == {1: 2.0, 2: None}


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("groups", [[], ["g"]])
def test_running_totals(spark, descending, groups):
    r = np.random.default_rng(3)
    rows = pd.DataFrame({"x": np.arange(900.0), "g": r.integers(0, 3, 900), "n": r.integers(1, 9, 900)})
    got = running_totals(spark.createDataFrame(rows), "x", ["n"], groups, descending).toPandas()
    want = rows.sort_values("x", ascending=not descending)
    key = want["g"] if groups else pd.Series(0, index=want.index)
    want = want.assign(
        n_upto=want.groupby(key)["n"].cumsum(), n_total=want.groupby(key)["n"].transform("sum")
    )
    merged = got.merge(want, on="x", suffixes=("", "_w"))
    assert len(merged) == 900
    assert (merged["n_upto"] == merged["n_upto_w"]).all()
    assert (merged["n_total"] == merged["n_total_w"]).all()
