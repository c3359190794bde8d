import pytest
from pyspark.sql import functions as F

from lendframe.operators import quality
from lendframe.schema import LOAN_RULES


def rows(df):
    return sorted(df.collect(), key=str)


@pytest.fixture
def folder(tmp_path):
    return f"{tmp_path}/table"


def test_issues_and_table_equal_those_of_a_separate_check(raw, folder):
    dirty = raw.withColumn("grade", F.when(F.col("loan_id") % 10 == 0, F.concat(F.lit("X"), F.col("grade"))).otherwise(F.col("grade")))
    dirty = dirty.withColumn("dti", F.when(F.col("loan_id") % 7 == 0, F.lit(-5.0)).otherwise(F.col("dti")))
    done = quality.write_checked(dirty, folder)
    assert rows(done.issues) == rows(quality.issues(dirty, LOAN_RULES))
    assert done.table.schema == dirty.schema
    assert rows(done.table) == rows(dirty)
    assert rows(done.offenders) == rows(quality.unexpected_values(dirty))
    values = {r["value"] for r in done.offenders.filter("column = 'grade'").collect()}
    assert values and all(v.startswith("X") for v in values)


def test_source_is_computed_once(raw, spark, folder):
    """Counted by an accumulator in a mapped source; what follows reads the written files."""
    calls = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            calls.add(len(batch))
            yield batch

    counted = raw.mapInPandas(count, raw.schema)
    done = quality.write_checked(counted, folder)
    assert done.issues.count() > 0 and done.offenders.count() >= 0
    assert calls.value == raw.count()
    plan = done.issues._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInPandas" not in plan


@pytest.mark.parametrize("make", [lambda raw: raw.limit(0), lambda raw: raw.filter("loan_id < 0"), lambda raw: raw.filter("false")])
def test_empty_table(raw, folder, make):
    done = quality.write_checked(make(raw), folder, checks=("nulls", "ranges", "categories", "statistics"))
    assert [(r["check"], r["severity"]) for r in done.issues.collect()] == [("empty", "error")]
    assert done.table.count() == 0 and done.offenders.count() == 0


def test_chosen_checks_and_clashing_names(frame_of, folder):
    df = frame_of({"grade": "H"}, {"dti": -1.0}, {"grade": None}).withColumn("rows", F.lit(3)).withColumn("outside grade", F.lit(None))
    done = quality.write_checked(df.drop("outside grade"), folder, checks=("ranges", "categories"))
    found = {(r["check"], r["column"]): r["observed"] for r in done.issues.collect()}
    assert found == {("ranges", "dti"): 1.0, ("categories", "grade"): 1.0}
    with pytest.raises(Exception, match="(?i)exist"):
        quality.write_checked(df, folder)
    again = quality.write_checked(df.withColumn("outside grade", F.lit("x")), folder, mode="overwrite")
    assert rows(again.offenders) == [("grade", "H", 1)]
