import pytest
from pyspark.sql import functions as F

from conftest import loan
from lendframe.operators import requests, score, split, train
from lendframe.operators.lookup import align, attach, split_by_ids
from lendframe.operators.prepare import PreparationEstimator
from lendframe.schema import LOAN_SCHEMA
from lendframe.sources import ingest, io, lake
from lendframe.sources.store import FeatureStore
from lendframe.streaming import jobs


def same(a, b):
    return a.exceptAll(b.select(a.columns)).isEmpty() and a.count() == b.count()


@pytest.mark.parametrize("suffix", ["csv", "parquet", "json"])
def test_round_trip_keeps_rows_and_leading_blanks(spark, raw, tmp_path, suffix):
    path = f"{tmp_path}/loans.{suffix}"
    io.write(raw, path)
    back = io.read_loans(spark, path)
    assert back.columns == raw.columns and same(back, raw)
    assert {r[0] for r in back.select("term").distinct().collect()} == {" 36 months", " 60 months"}
    store = io.ObjectStore(spark, f"file:{tmp_path}/store")
    store.write(raw.limit(5), f"a/b.{suffix}")
    assert store.read(f"a/b.{suffix}").count() == 5
    assert store.list_files("a").filter(F.col("path").contains("part-")).count() >= 1


def test_csv_columns_are_matched_by_name_and_bad_numbers_become_null(spark, tmp_path):
    (tmp_path / "x.csv").write_text("Unnamed: 0,dti,grade,loan_amnt\n0,1.5,A,oops\n1,NaN,B,7\n")
    rows = io.read_loans(spark, f"{tmp_path}/x.csv").collect()
    assert [tuple(r) for r in rows] == [(None, "A", 1.5), (7.0, "B", None)]
    with pytest.raises(ValueError, match="missing columns"):
        io.as_loans(io.read(spark, f"{tmp_path}/x.csv"), strict=True)
    assert dict(io.read(spark, f"{tmp_path}/x.csv", infer=True).dtypes)["dti"] == "double"


def test_format_and_path_errors(spark, raw, tmp_path):
    with pytest.raises(FileNotFoundError):
        io.read(spark, f"{tmp_path}/none.parquet")
    with pytest.raises(ValueError, match="unsupported"):
        io.read(spark, f"{tmp_path}/x.xyz")
    with pytest.raises(ValueError, match="unsupported"):
        io.write(raw, f"{tmp_path}/x.xyz")
    io.write(raw.limit(3), f"{tmp_path}/plain")
    assert io.read(spark, f"{tmp_path}/plain", "parquet").count() == 3


def test_partitioned_output_is_pruned_and_single_file_is_guarded(spark, raw, tmp_path):
    spark.conf.set("spark.sql.maxMetadataStringLength", 100000)
    io.write_partitioned(raw, f"{tmp_path}/p")
    paid = spark.read.parquet(f"{tmp_path}/p").filter("loan_status = 'Fully Paid'")
    plan = paid._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(loan_status" in plan
    assert paid.count() == raw.filter("loan_status = 'Fully Paid'").count()
    io.write_single_file(raw, f"{tmp_path}/one")
    assert len(list((tmp_path / "one").glob("part-*"))) == 1


def test_warehouse_options(spark, raw):
    assert io.jdbc_options("jdbc:x", fetchsize=10) == {"url": "jdbc:x", "fetchsize": "10"}
    with pytest.raises(ValueError, match="mode"):
        io.warehouse_write(raw, "jdbc:x", "t", mode="upsert")


def test_lake_tables(spark, raw, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS lendtest LOCATION '" + f"{tmp_path}/db'")
    try:
        lake.save_table(raw.select("loan_id", "grade"), "lendtest.loans", f"file:{tmp_path}/t")
        assert lake.lake_table(spark, "lendtest", "loans").count() == 1000
        got = lake.lake_query(spark, "SELECT count(*) AS n FROM lendtest.loans l JOIN extra e ON l.grade = e.grade", {"extra": raw.select("grade").distinct()})
        assert got.first()["n"] == 1000
        wider = raw.select("loan_id", "grade", "dti")
        assert lake.update_table_schema(spark, "lendtest.loans", wider) == ["dti"]
        assert lake.update_table_schema(spark, "lendtest.loans", wider) == []
        assert spark.table("lendtest.loans").columns == ["loan_id", "grade", "dti"]
    finally:
        spark.sql("DROP DATABASE lendtest CASCADE")
    change = lake.schema_difference(raw.select("grade", "dti"), raw.select(F.col("dti").cast("int").alias("dti"), "term"))
    assert {(r["column"], r["change"]) for r in change.collect()} == {("term", "added"), ("grade", "removed"), ("dti", "retyped")}


def test_ingestion_keeps_data_files_in_any_case(spark, tmp_path):
    for name in ("a.csv", "b.JSON", "c.Parquet", "d.txt", "csv"):
        (tmp_path / name).write_text("x" * 10)
    log = ingest.ingestion_log(spark, str(tmp_path)).collect()
    assert {r["path"].rsplit("/", 1)[1] for r in log} == {"a.csv", "b.JSON", "c.Parquet"}
    assert {(r["size"], r["status"]) for r in log} == {(10, "ingested")}
    files = io.list_files(spark, str(tmp_path))
    assert tuple(ingest.ingestion_status(files).first()) == (5, 0.0)
    assert [r["path"].rsplit("/", 1)[1] for r in ingest.first_files(files, 2).collect()] == ["a.csv", "b.JSON"]


def test_feature_store(spark, raw, tmp_path):
    store = FeatureStore(spark, f"file:{tmp_path}/fs")
    assert store.feature_sets().isEmpty()
    first = raw.select("loan_id", "dti", "grade")
    assert store.save(first, "base", "1", "first", {"team": "risk"}) == "base_v1"
    store.save(raw.select("loan_id", "dti"), "base", "2")
    store.save(raw.select("loan_id"), "other", "1")
    assert same(store.load("base", "1"), first)
    assert store.load("base").columns == ["loan_id", "dti"]
    assert store.load("base", "1", ["grade"]).columns == ["grade"]
    meta = store.metadata("base", "1").first()
    assert (meta["row_count"], meta["column_count"], meta["tags"]) == (1000, 3, {"team": "risk"})
    assert {tuple(r) for r in store.feature_sets().collect()} == {("base", "2", 2), ("other", "1", 1)}
    assert [r["version"] for r in store.versions("base").collect()] == ["1", "2"]
    store.save(first.repartition(5), "base", "3")
    assert store.metadata("base", "3").first()["fingerprint"] == meta["fingerprint"]
    with pytest.raises(ValueError):
        store.load("nothing")
    with pytest.raises(ValueError):
        store.load("base", "9")


def test_request_bounds_and_defaults(spark):
    rows = [loan(loan_id=1), loan(loan_id=2, dti=-1.0), loan(loan_id=3, int_rate=101.0, grade=None), loan(loan_id=4, pub_rec=None, revol_bal=None, revol_util=None)]
    accepted, refused = requests.check_requests(spark.createDataFrame(rows, LOAN_SCHEMA))
    got = {r["loan_id"]: r for r in accepted.collect()}
    assert set(got) == {1, 4} and got[4]["pub_rec"] == 0.0
    assert {r["loan_id"]: r["reasons"] for r in refused.collect()} == {2: ["dti"], 3: ["int_rate", "grade"]}


def test_lookup_joins(spark):
    rows = spark.createDataFrame([(i, i % 3 if i % 5 else None) for i in range(60)], "loan_id int, k int")
    table = spark.createDataFrame([(0, "a"), (1, "b")], "k int, v string")
    a, b = attach(rows, table, "k", True), attach(rows, table, "k", False)
    assert same(a, b) and a.count() == 60
    inside, outside = split_by_ids(rows, rows.limit(7), "loan_id")
    assert (inside.count(), outside.count()) == (7, 53)
    assert align(rows, rows.withColumn("p", F.lit(1)), "loan_id", ["p"]).columns == ["loan_id", "k", "p"]


def test_splits_are_stable_disjoint_and_even(raw):
    parts = split.with_split(raw)
    again = split.with_split(raw.repartition(7).orderBy(F.rand()))
    assert same(parts.select("loan_id", "split"), again.select("loan_id", "split"))
    by = {(r[0], r[1]): r[2] for r in parts.groupBy("loan_status", "split").count().collect()}
    for status in ("Fully Paid", "Charged Off"):
        share = by[(status, "test")] / (by[(status, "test")] + by[(status, "train")])
        assert 0.13 < share < 0.28
    folds = {r["fold"]: r["count"] for r in split.with_fold(raw).groupBy("fold").count().collect()}
    assert set(folds) == {0, 1, 2, 3, 4} and sum(folds.values()) == 1000
    sample = split.sample_rows(raw, 100)
    assert sample.count() == 100 and same(sample, split.sample_rows(raw.repartition(3), 100))
    small, large = split.share(raw, 0.2), split.share(raw, 0.6)
    assert small.exceptAll(large).isEmpty()


@pytest.fixture(scope="module")
def scorer(raw):
    preparation = PreparationEstimator(2025, include_target=False).fit(raw)
    with_target = PreparationEstimator(2025).fit(raw).transform(raw)
    model = train.fit(train.labelled(with_target), "gbt", {"n_estimators": 2, "max_depth": 2})
    return score.Scorer(preparation, model, 0.5, "v1")


def test_stream_scores_equal_batch_scores_and_survive_a_restart(spark, raw, scorer, tmp_path):
    folder, out, refused = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/refused"
    first, second = raw.filter("loan_id < 600"), raw.filter("loan_id >= 600")
    bad = first.limit(4).withColumn("dti", F.lit(-5.0)).withColumn("loan_id", F.col("loan_id") + 5000)

    def run():
        rows = jobs.loan_stream(spark, folder, files_per_batch=1)
        a = jobs.score_stream(scorer, rows, out, f"{tmp_path}/c1")
        b = jobs.refuse_stream(scorer, rows, refused, f"{tmp_path}/c2")
        a.awaitTermination(120)
        b.awaitTermination(120)

    undated = first.limit(3).withColumn("earliest_cr_line", F.lit("xx")).withColumn("loan_id", F.col("loan_id") + 7000)
    first.unionByName(bad).unionByName(undated).write.mode("append").json(folder)
    run()
    second.write.mode("append").json(folder)
    run()
    run()
    batch, _ = scorer.score_requests(raw)
    assert same(spark.read.parquet(out), batch) and batch.count() == 1000
    left_out = spark.read.parquet(refused).groupBy("stage").count().collect()
    assert {r["stage"]: r["count"] for r in left_out} == {"bounds": 4, "preparation": 3}
    scorer.set_threshold(0.9)
    assert scorer.score(raw).first()["threshold"] == 0.9
    scorer.set_threshold(0.5)


def test_file_log_stream_adds_each_file_once(spark, tmp_path):
    folder, log, checkpoint = tmp_path / "in", f"{tmp_path}/log", f"{tmp_path}/c"
    folder.mkdir()

    def run():
        jobs.log_new_files(spark, str(folder), log, checkpoint).awaitTermination(60)
        return sorted(r["path"].rsplit("/", 1)[1] for r in spark.read.parquet(log).collect())

    (folder / "a.csv").write_text("x")
    (folder / "skip.txt").write_text("x")
    assert run() == ["a.csv"]
    assert run() == ["a.csv"]
    (folder / "b.JSON").write_text("y")
    assert run() == ["a.csv", "b.JSON"]
