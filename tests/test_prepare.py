import pytest
from pyspark.sql import functions as F

from lendframe.functions import cleaning
from lendframe.operators.prepare import PreparationEstimator, PreparationModel
from lendframe.schema import PREPARED
from lendframe.session import local_copy


def test_transform_keeps_the_fixed_columns_and_leaves_no_null(raw):
    out = PreparationEstimator(2025).fit(raw).transform(raw)
    assert out.columns == ["loan_id", *PREPARED, "loan_status"]
    assert out.count() == 1000
    assert out.na.drop("any").count() == 1000


def test_save_and_load_give_the_same_rows(spark, raw, tmp_path):
    for dialect in ("library", "etl"):
        model = PreparationEstimator(2025, dialect).fit(raw)
        model.save(f"{tmp_path}/{dialect}")
        again = PreparationModel.load(spark, f"{tmp_path}/{dialect}")
        assert again.transform(raw).exceptAll(model.transform(raw)).isEmpty()
        assert again.transform(raw).count() == model.transform(raw).count()


def test_every_row_is_either_prepared_or_rejected_with_a_reason(frame_of):
    df = frame_of(
        {},
        {"annual_inc": 0.0},
        {"annual_inc": None},
        {"earliest_cr_line": "xx"},
        {"total_acc": 0.0},
        {"grade": None},
        {"annual_inc": float("nan")},
        {"earliest_cr_line": "2010-01-15"},
        {"title": None, "address": None},
    )
    model = PreparationEstimator(2025).fit(df)
    assert {r["loan_id"] for r in model.transform(df).collect()} == {0, 7, 8}
    reasons = {r["loan_id"]: r["reasons"] for r in model.rejected(df).collect()}
    assert reasons[1] == ["annual_inc not positive"]
    assert reasons[2] == ["annual_inc not positive"]
    assert reasons[3] == ["earliest_cr_line unreadable"]
    assert reasons[4] == ["total_acc not positive"]
    assert reasons[5] == ["grade missing"]
    assert set(reasons) == {1, 2, 3, 4, 5, 6}


def test_mort_acc_uses_the_group_then_the_global_median_only_for_unknown_groups(frame_of):
    train = frame_of(
        {"total_acc": 1.0, "mort_acc": 1.0},
        {"total_acc": 1.0, "mort_acc": 4.0},
        {"total_acc": 2.0, "mort_acc": None},
        {"total_acc": 3.0, "mort_acc": 9.0},
    )
    model = PreparationEstimator(2025).fit(train)
    assert model.medians["mort_acc"] == 4.0
    asked = frame_of(
        {"total_acc": 1.0, "mort_acc": None},
        {"total_acc": 2.0, "mort_acc": None},
        {"total_acc": 77.0, "mort_acc": None},
        {"total_acc": None, "mort_acc": None},
        {"total_acc": 1.0, "mort_acc": 0.0},
    )
    got = {r["loan_id"]: r["mort_acc"] for r in model.imputed(asked).collect()}
    assert got == {0: 2.5, 1: None, 2: 4.0, 3: 4.0, 4: 0.0}


def test_etl_rules_have_no_global_fallback_and_take_the_lower_median(frame_of):
    train = frame_of({"total_acc": 1.0, "mort_acc": 1.0}, {"total_acc": 1.0, "mort_acc": 4.0})
    model = PreparationEstimator(2025, "etl").fit(train)
    asked = frame_of({"total_acc": 1.0, "mort_acc": None}, {"total_acc": 5.0, "mort_acc": None})
    got = {r["loan_id"]: r["mort_acc"] for r in model.imputed(asked).collect()}
    assert got == {0: 1.0, 1: None}
    assert [r["loan_id"] for r in model.transform(asked).collect()] == [0]


def test_etl_drops_open_loans_and_unreadable_employment(frame_of):
    df = frame_of({}, {"loan_status": "Current"}, {"emp_length": "n/a"}, {"emp_length": None})
    rows = PreparationEstimator(2025, "etl").fit(df).transform(df).collect()
    assert {r["loan_id"]: r["emp_length"] for r in rows} == {0: 5, 3: -1}


def test_large_groups_give_the_same_result_as_small_ones(raw, monkeypatch):
    small = PreparationEstimator(2025).fit(raw)
    monkeypatch.setattr("lendframe.operators.prepare.local_copy", lambda df: local_copy(df, 3))
    large = PreparationEstimator(2025).fit(raw)
    assert small.groups_small and not large.groups_small
    assert small.medians == large.medians
    a, b = small.transform(raw), large.transform(raw)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_strict_asks_for_every_column(raw):
    model = PreparationEstimator(2025).fit(raw)
    with pytest.raises(ValueError, match="purpose"):
        model.transform(raw.drop("purpose"))
    model.strict = False
    assert "purpose" not in model.transform(raw.drop("purpose")).columns


@pytest.mark.parametrize(
    "text,years,number",
    [
        ("10+ years", "10", 10),
        (" < 1 year ", "0", 1),
        ("< 1 year", "0", 0),
        ("3 years", "3", 3),
        ("  7 years", "7", 7),
        ("n/a", "Unknown", None),
        ("", "Unknown", None),
        ("3.5 years", "Unknown", 3),
        (None, "Unknown", None),
        ("Unknown", "Unknown", -1),
    ],
)
def test_employment_length(spark, text, years, number):
    df = spark.createDataFrame([(text,)], "e string")
    row = df.select(cleaning.emp_length_text(F.col("e")), cleaning.emp_length_number(F.col("e"))).first()
    assert tuple(row) == (years, number)


def test_bins_and_target(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (None,)], "x double")
    got = df.select(cleaning.zero_one_more(F.col("x")), cleaning.bankruptcy_bin(F.col("x"))).collect()
    assert [tuple(r) for r in got] == [("0", "0"), ("1", "1"), ("2+", "2+"), ("2+", "0")]
    status = spark.createDataFrame([("Fully Paid",), ("Charged Off",), ("Current",), (None,)], "s string")
    assert [r[0] for r in status.select(cleaning.target_code(F.col("s"))).collect()] == [1, 0, None, None]


def test_plan_has_no_python_and_filters_reach_the_scan(spark, raw, tmp_path):
    spark.conf.set("spark.sql.maxMetadataStringLength", 100000)
    raw.write.parquet(f"{tmp_path}/raw")
    stored = spark.read.parquet(f"{tmp_path}/raw")
    out = PreparationEstimator(2025).fit(stored).transform(stored)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert "GreaterThan(annual_inc,0.0)" in plan
    assert "address" not in plan.split("ReadSchema")[1]


@pytest.mark.parametrize("limit", [2, 1000])
def test_codes_from_a_vocabulary_table_of_any_size(spark, limit):
    from lendframe.operators import encode

    known = spark.createDataFrame([("b", 3), ("a", 1), ("c", 3), (None, 2)], "x string, y int")
    rows = spark.createDataFrame([("a", 3, 0), ("z", None, 1), (None, 1, 2), ("c", 9, 3)] * 2, "x string, y int, x_n int")
    vocab = encode.vocabulary(known, ["x", "y"])
    got = encode.code_by_table(rows, vocab, ["x", "y"], limit=limit)
    assert got.columns == ["x", "y", "x_n", "x_code", "y_code"]
    want = {0: (0, 2), 1: (3, 3), 2: (3, 0), 3: (2, 3)}
    assert sorted((r["x_n"], r["x_code"], r["y_code"]) for r in got.collect()) == sorted([(k, *v) for k, v in want.items()] * 2)
    same = encode.label_encode(rows, encode.fitted_labels(vocab), ["x", "y"])
    assert got.exceptAll(same).isEmpty() and same.exceptAll(got).isEmpty()
