import hashlib
import zlib

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from lendframe.llm import decontaminate, minhash, quality, secret_scan
from lendframe.llm.common import held_out, read_table, vocabulary_path
from lendframe.llm.queries import ENCODER, RANKS, op3_quality

SMALL = "/root/testdata/sf0.01"


def test_held_out_is_crc32(spark):
    frame = spark.createDataFrame([(i,) for i in [*range(-5, 200), None]], "doc_id long")
    for r in frame.select("doc_id", held_out(F.col("doc_id")).alias("h")).collect():
        assert r.h == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)


def test_held_out_accuracy(spark):
    scored = op3_quality(spark, SMALL)
    labels = read_table(spark, SMALL, "labels")
    rows = scored.where("held_out").join(labels, "doc_id").where("quality IS NOT NULL").collect()
    assert len(rows) > 50
    assert sum(r.predicted == r.quality for r in rows) / len(rows) >= 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= quality.ACCEPT) for r in rows)


def test_held_out_labels_are_not_used(spark):
    docs, labels = read_table(spark, SMALL, "documents"), read_table(spark, SMALL, "labels")
    turned = labels.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    left = [x.where(~held_out(F.col("doc_id"))) for x in (labels, turned)]
    assert quality.fit(docs, left[0]) == quality.fit(docs, left[1])


@pytest.mark.parametrize("lookup_rows", [quality.LOOKUP_ROWS, 10])
def test_threshold_counts_labels_beyond_the_sample(spark, monkeypatch, lookup_rows):
    monkeypatch.setattr(quality, "SAMPLE_PER_CLASS", 20)
    monkeypatch.setattr(quality, "LOOKUP_ROWS", lookup_rows)
    # 200 good and 30 poor documents whose features overlap.
    rows = [(i, " ".join(["word%d" % (i * j % 9) for j in range(1, 30)] + ["#"] * (i % 7 + 3 * (i < 30)))) for i in range(230)]
    docs = spark.createDataFrame([*rows, rows[3], (None, "a b")], "doc_id long, text string")
    marks = spark.createDataFrame([(i, int(i >= 30)) for i in range(230)], "doc_id long, quality int")
    model = quality.fit(docs, marks)
    raw = sorted(float(model.raw(quality.features(t))) for _, t in rows)
    assert model.threshold == pytest.approx((raw[29] + raw[30]) / 2, abs=1e-9)


def test_odd_rows_and_missing_labels(spark):
    docs = spark.createDataFrame(
        [(1, "good text here", 1.0), (2, None, 1.0), (3, "", 1.0), (None, "x!!", 1.0), (1, "good text here", 1.0), (4, "w " * 50_000, 1.0)],
        "doc_id long, text string, score double",
    )
    empty = spark.createDataFrame([], "doc_id long, quality int")
    model = quality.fit(docs, empty)
    rows = quality.score(docs, model).collect()
    assert len(rows) == 6 and all(r.score == pytest.approx(quality.ACCEPT) for r in rows)
    marks = spark.createDataFrame([(1, 1), (2, 0), (3, None), (4, 1), (4, 0)], "doc_id long, quality int")
    rows = {r.doc_id: r.score for r in quality.score(docs, quality.fit(docs, marks)).collect()}
    assert rows[1] > rows[2] == rows[3]
    assert quality.score(docs.limit(0), model).count() == 0


def test_stages_against_plain_python(spark, sf_dir):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "decontamination", "secrets", "tokens"]
    docs = read_table(spark, sf_dir, "documents").cache()
    out, at = {}, docs
    for name, stage in corpus_pipeline.STAGES:
        at = stage(spark, at, sf_dir).cache()
        out[name] = {r.doc_id: r for r in at.collect()}
        if name != "tokens":
            assert at.columns == docs.columns and at.dtypes == docs.dtypes
    model = quality.fit(docs, read_table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id"))))
    good = {r.doc_id for r in quality.score(docs, model).where("predicted = 1").collect()}
    assert set(out["quality"]) == good
    kept = {r.doc_id for r in minhash.near_duplicates(docs.where(F.col("doc_id").isin(list(good))), 5, 80).where("kept").collect()}
    assert set(out["near_duplicates"]) == kept
    items = [(r.item_id, r.text) for r in read_table(spark, sf_dir, "benchmark").collect()]
    matcher = decontaminate.Matcher(items, decontaminate.RATE, decontaminate.MIN_WORDS)
    assert set(out["decontamination"]) == {i for i, r in out["near_duplicates"].items() if not matcher.matches(r.text)}
    ranks = secret_scan.tokenizer(vocabulary_path(RANKS))
    library = Tokenizer.from_file(vocabulary_path(ENCODER))
    assert set(out["secrets"]) == set(out["tokens"]) == set(out["decontamination"])
    for i, before in out["decontamination"].items():
        text = secret_scan.redacted(before.text, secret_scan.spans_of(before.text, ranks))
        assert out["secrets"][i].text == text
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert list(out["tokens"][i].token_ids) == ids
        assert out["tokens"][i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_stages_take_odd_rows(spark, sf_dir):
    docs = spark.createDataFrame(
        [(1, None, None, None, None), (None, "a b c", "en", "s", 5), (None, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0)],
        read_table(spark, sf_dir, "documents").schema,
    )
    for rows in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            got = stage(spark, rows, sf_dir).collect()
            assert len(got) <= rows.count()
            if name in ("secrets", "tokens"):
                assert len(got) == rows.count()


def test_stages_take_columns_with_clashing_names(spark, sf_dir):
    names = (
        "predicted", "score", "_row", "kept", "_document", "_result", "component_id", "n_shingles", "item_id", "distance",
        "matches", "spans", "ids_sha256", "_id", "_order", "held_out", "quality", "x", "bucket", "node",
    )
    plain = read_table(spark, sf_dir, "documents")
    docs = plain.withColumns({n: F.lit(f"own {n}") for n in names})
    for name, stage in corpus_pipeline.STAGES:
        got, want = stage(spark, docs, sf_dir), stage(spark, plain, sf_dir)
        if name != "tokens":
            assert got.columns == docs.columns and got.where(" OR ".join(f"{n} != 'own {n}'" for n in names)).isEmpty()
        got, want = got.select(want.columns).collect(), want.collect()
        assert sorted(map(str, got)) == sorted(map(str, want)) and len(got) > 0
