import pytest

from lendframe.jobs import runs
from lendframe.sources import io

QUICK = {"n_estimators": 2, "max_depth": 2, "min_child_samples": 5}


def test_train_evaluate_and_score(spark, raw, tmp_path):
    data, out = f"{tmp_path}/loans.csv", f"file:{tmp_path}/out"
    io.write(raw, data)
    version = runs.train(spark, data, out, 2025, params=QUICK)
    assert spark.read.parquet(f"{out}/prepared").count() == 1000
    assert not spark.read.parquet(f"{out}/issues").isEmpty()
    assert {r["split"] for r in spark.read.parquet(f"{out}/evaluation").collect()} == {"train", "test"}
    assert spark.read.parquet(f"{out}/importance").count() == 19
    chosen = runs.evaluate(spark, data, out).first()
    fixed = runs.evaluate(spark, data, out, threshold=0.0).first()
    assert fixed["threshold"] == 0.0 and chosen["f1"] >= fixed["f1"] - 1e-12
    scores = runs.score(spark, data, out, threshold=0.3)
    row = scores.first()
    assert scores.count() == 1000 and row["threshold"] == 0.3 and row["model_version"] == version
    assert spark.read.parquet(f"{out}/unscored").isEmpty()


def test_invalid_loans_stop_the_job_only_when_asked(raw, tmp_path):
    assert runs.validated(raw, f"file:{tmp_path}/a") is False
    with pytest.raises(ValueError, match="invalid"):
        runs.validated(raw, f"file:{tmp_path}/b", "raise")
    with pytest.raises(ValueError, match="loan_id"):
        runs.with_row_key(raw.drop("loan_id"))


def test_etl_job(spark, raw, tmp_path):
    raw.createOrReplaceTempView("raw_loans")
    stats = runs.etl(spark, "raw_loans", f"file:{tmp_path}/etl", 2025)
    assert {r["column"] for r in stats.collect()} == {"int_rate", "annual_inc", "dti", "revol_util"}
    written = spark.read.parquet(f"{tmp_path}/etl/prepared")
    assert {"etl_timestamp", "etl_job_name"} <= set(written.columns)
    assert spark.read.parquet(f"{tmp_path}/etl/target").count() == 2
