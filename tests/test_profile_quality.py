from collections import Counter

import numpy as np
import pandas as pd
import pytest

from lendframe.functions.records import fingerprint, flatten_struct
from lendframe.operators import drift, features, profile, quality
from lendframe.operators.features import Feature, default_registry
from lendframe.schema import LOAN_RULES, RuleSet


def test_the_sample_breaks_the_null_limits_it_should(raw):
    found = quality.check_nulls(raw.drop("loan_id")).collect()
    assert {r["column"] for r in found if r["severity"] == "error"} == {
        "emp_title", "emp_length", "title", "mort_acc", "pub_rec_bankruptcies",
    }


def test_schema_check(raw, spark):
    bad = raw.drop("dti", "purpose").withColumn("grade", raw["loan_amnt"])
    found = {(r["check"], r["column"]): r["severity"] for r in quality.check_schema(bad).collect()}
    assert found[("schema_missing", "dti")] == "error"
    assert found[("schema_missing", "purpose")] == "error"
    assert found[("schema_extra", "loan_id")] == "warning"
    assert found[("schema_type", "grade")] == "warning"


def test_ranges_below_is_error_above_is_warning_bounds_are_inclusive(frame_of):
    df = frame_of({"dti": 0.0}, {"dti": 100.0}, {"dti": -1.0}, {"dti": 101.0}, {"dti": None})
    got = {(r["column"], r["severity"]): r["observed"] for r in quality.check_ranges(df).collect()}
    assert got == {("dti", "error"): 1.0, ("dti", "warning"): 1.0}


def test_categories_list_every_offender(frame_of):
    df = frame_of({"term": "36 months"}, {"grade": "H"}, {"grade": "I"}, {"grade": None}, {})
    assert {(r["column"], r["value"]) for r in quality.unexpected_values(df).collect()} == {
        ("term", "36 months"), ("grade", "H"), ("grade", "I"),
    }
    assert {r["column"]: r["observed"] for r in quality.check_categories(df).collect()} == {"term": 1.0, "grade": 2.0}


def test_verdict_switches_and_custom_rules(frame_of):
    df = frame_of(*[{"loan_status": "Fully Paid"}] * 3, {"loan_status": "Charged Off"}).drop("loan_id")
    rules = RuleSet(allowed={"grade": ("A",)}, required={c: "text" for c in ("grade",)}, default_null_limit=100.0)
    found, verdict = quality.validate(df, rules, checks=("categories",))
    assert [r["check"] for r in found.collect()] == ["categories"]
    assert verdict.first()["is_valid"] is True
    assert quality.validate(df, rules, strict=True, checks=("categories",))[1].first()["is_valid"] is False
    assert quality.validate(df, rules, checks=())[1].first()["warnings"] == 0
    checks = {r["check"] for r in quality.issues(df, LOAN_RULES, ("statistics",)).collect()}
    assert checks == {"duplicates"}


def test_empty_table_is_one_error_and_divides_nothing(raw):
    empty = raw.limit(0)
    found = quality.issues(empty, checks=("nulls", "ranges", "categories", "statistics")).collect()
    assert [(r["check"], r["severity"]) for r in found] == [("empty", "error")]
    assert profile.null_report(empty).first()["null_percentage"] is None


def test_duplicates_count_equal_nulls(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a"), (1, None)], "a int, b string")
    assert tuple(profile.duplicate_rows(df).first()) == (4, 2, 50.0)
    # The same values in other columns are other rows.
    turned = spark.createDataFrame([(1, None), (None, 1), (1, None), (0, 1)], "a int, b int")
    assert tuple(profile.duplicate_rows(turned).first()) == (4, 1, 25.0)
    assert tuple(profile.duplicate_rows(turned.limit(0)).first()) == (0, 0, None)


def test_summary_matches_pandas(raw):
    pdf = raw.toPandas()
    got = {r["column"]: r for r in profile.summary(raw).collect()}
    for c in ("loan_amnt", "dti", "mort_acc"):
        d = pdf[c].describe()
        for ours, theirs in (("count", "count"), ("mean", "mean"), ("std", "std"), ("q25", "25%"), ("q75", "75%"), ("max", "max")):
            assert float(got[c][ours]) == pytest.approx(d[theirs], rel=1e-9)
    counts = Counter(pdf["grade"])
    assert got["grade"]["unique"] == 7
    assert got["grade"]["top"] == min(counts, key=lambda g: (-counts[g], g))


def test_skewness_and_box(raw, spark):
    pdf = raw.toPandas()
    assert raw.agg(profile.corrected_skewness("dti")).first()[0] == pytest.approx(pdf["dti"].skew(), abs=1e-9)
    for r in profile.box_stats(raw, ["annual_inc"], "loan_status").collect():
        v = pdf.loc[pdf.loan_status == r["loan_status"], "annual_inc"]
        q1, q3 = v.quantile(0.25), v.quantile(0.75)
        assert (r["q1"], r["q3"]) == (pytest.approx(q1), pytest.approx(q3))
        assert r["low_whisker"] == v[v >= q1 - 1.5 * (q3 - q1)].min()
        assert r["high_whisker"] == v[v <= q3 + 1.5 * (q3 - q1)].max()


def test_histogram_matches_numpy_and_handles_constant_columns(spark, raw):
    pdf = raw.toPandas()
    counts, edges = np.histogram(pdf["dti"], bins=30)
    got = {r["bin"]: r for r in profile.histogram(raw, {"dti": 30}).collect()}
    assert [got[i]["n"] if i in got else 0 for i in range(30)] == counts.tolist()
    assert got[0]["low"] == pytest.approx(edges[0])
    flat = profile.histogram(spark.createDataFrame([(2.0,), (2.0,)], "x double"), {"x": 5}).collect()
    assert [(r["bin"], r["n"]) for r in flat] == [(0, 2)]


def test_correlations(raw):
    pdf = raw.toPandas()[["loan_amnt", "dti", "mort_acc"]]
    for r in profile.pair_correlations(raw, list(pdf.columns)).collect():
        assert r["correlation"] == pytest.approx(pdf[r["feature_1"]].corr(pdf[r["feature_2"]]), abs=1e-9)
    assert profile.correlated_pairs(raw, list(pdf.columns), 0.99).isEmpty()


def test_correlations_far_from_zero_with_gaps_and_without_spread(spark):
    source = np.random.default_rng(6)
    x = source.normal(size=(3000, 3)) + 1e9
    x[:, 1] += x[:, 0] - 1e9
    x[source.random((3000, 3)) < 0.2] = np.nan
    pdf = pd.DataFrame(np.column_stack([x, np.full(3000, 7.0), np.full(3000, np.nan)]), columns=list("abcde"))
    pdf.loc[0, "e"] = 1.0
    df = spark.createDataFrame(pdf).repartition(11)
    got = {(r["feature_1"], r["feature_2"]): r["correlation"] for r in profile.correlation_matrix(df, list("abcde")).collect()}
    assert len(got) == 25 and all(got[(c, c)] == 1.0 for c in "abcde")
    want = pdf.corr()
    for a, b in [("a", "b"), ("b", "a"), ("a", "c"), ("c", "b")]:
        assert got[(a, b)] == pytest.approx(want.loc[a, b], abs=1e-6)
    assert all(got[p] is None for p in got if p[0] != p[1] and ("d" in p or "e" in p))
    assert profile.pair_correlations(df.limit(0), ["a", "b"]).collect()[0]["correlation"] is None


def test_feature_registry(raw):
    registry = default_registry(2025)
    out, skipped = registry.create(raw.drop("dti"), ["loan_to_income", "dti_bucket", "nonsense"])
    assert set(skipped) == {"dti_bucket", "nonsense"} and "loan_to_income" in out.columns
    registry.register(Feature("loan_to_income", "doubled", lambda: raw["loan_amnt"] * 2, ("loan_amnt",), "2"))
    registry.register(Feature("twice", "reads another feature", lambda: __import__("pyspark.sql.functions").sql.functions.col("loan_to_income") * 2, ("loan_to_income",)))
    out, skipped = registry.create(raw)
    row = out.select("loan_amnt", "loan_to_income", "twice").first()
    assert row["loan_to_income"] == row["loan_amnt"] * 2 and row["twice"] == row["loan_amnt"] * 4
    assert not skipped
    assert {r["name"]: r["version"] for r in registry.catalog(raw).collect()}["loan_to_income"] == "2"


@pytest.mark.parametrize("dti,label", [(0.0, None), (10.0, "very_low"), (10.1, "low"), (40.0, "high"), (100.0, "very_high"), (100.1, None)])
def test_buckets_are_closed_on_the_right(frame_of, dti, label):
    out, _ = default_registry().create(frame_of({"dti": dti}), ["dti_bucket"])
    assert out.first()["dti_bucket"] == label


def test_division_by_zero_income_gives_null(frame_of):
    out, _ = default_registry().create(frame_of({"annual_inc": 0.0, "total_acc": 0.0}))
    row = out.first()
    assert row["loan_to_income"] is None and row["active_credit_pct"] is None and row["debt_burden_score"] is None


def information(bins, label):
    d = pd.DataFrame({"b": bins, "y": label})
    out = 0.0
    for _, g in d.groupby(["b", "y"]):
        p = len(g) / len(d)
        out += p * np.log(p / ((d.b == g.b.iloc[0]).mean() * (d.y == g.y.iloc[0]).mean()))
    return out


def test_mutual_information_and_selection(spark):
    r = np.random.default_rng(0)
    y = r.integers(0, 2, 2000)
    data = pd.DataFrame({
        "y": y,
        "close": np.where(r.random(2000) < 0.8, y, 1 - y).astype(str),
        "noise": r.integers(0, 3, 2000).astype(str),
        "num": y * 1.0 + r.normal(0, 1, 2000),
    })
    df = spark.createDataFrame(data)
    got = {x["feature"]: x["importance"] for x in features.mutual_information(df, "y", ["close", "noise"], ["num"]).collect()}
    assert got["close"] == pytest.approx(information(data.close, y), abs=1e-9)
    cuts = [data.num.quantile(i / 10) for i in range(1, 10)]
    assert got["num"] == pytest.approx(information(np.searchsorted(cuts, data.num, side="left"), y), abs=1e-9)
    chosen, names = features.select_features(df, "y", ["close", "noise", "num"], 2, keep=["y"])
    assert names == ["close", "num"] or names == ["num", "close"]
    assert chosen.columns == ["y", *names]


def test_drift(spark):
    a = spark.createDataFrame([("x", 1.0)] * 50 + [("y", 2.0)] * 50, "t string, v double")
    same = {r["feature"]: r for r in drift.stability_index(a, a, ["t"], ["v"]).collect()}
    assert all(r["psi"] == 0.0 and not r["alert"] for r in same.values())
    b = spark.createDataFrame([("x", 1.0)] * 90 + [("y", 2.0)] * 5 + [(None, None)] * 5, "t string, v double")
    got = {r["feature"]: r for r in drift.stability_index(a, b, ["t"], ["v"]).collect()}
    want = sum((q - p) * np.log(q / p) for p, q in ((0.5, 0.9), (0.5, 0.05), (1e-6, 0.05)))
    assert got["t"]["psi"] == pytest.approx(want, abs=1e-9) and got["t"]["alert"]


def test_fingerprint_ignores_order_and_sees_values(spark):
    rows = [(1, "a"), (2, None), (3, "c"), (3, "c")]
    layout = "n int, t string"

    def mark(r, partitions=1):
        return fingerprint(spark.createDataFrame(r, layout).repartition(partitions)).first()["fingerprint"]

    assert mark(rows) == mark(rows[::-1], 3)
    assert mark(rows) != mark(rows[:3])
    assert mark(rows) != mark([(1, "a"), (2, "x"), (3, "c"), (3, "c")])
    assert mark([(1, None)]) != mark([(None, "1")])
    assert mark([]) and len(mark([])) == 12


def test_flatten_struct(spark):
    df = spark.sql("SELECT 1 AS a, named_struct('x', 2, 'y', named_struct('z', 3)) AS s")
    flat = flatten_struct(df)
    assert flat.columns == ["a", "s.x", "s.y.z"] and tuple(flat.first()) == (1, 2, 3)
    assert flatten_struct(df, "_").columns == ["a", "s_x", "s_y_z"]
