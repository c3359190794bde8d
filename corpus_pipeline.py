"""A cleaning pipeline over `documents`: quality, near duplicates, benchmark leaks, secrets, tokens.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again
as the next stage's docs. All but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendframe.llm import bpe, decontaminate, minhash, quality, secret_scan
from lendframe.llm.common import held_out, read_table, vocabulary_path
from lendframe.llm.queries import ENCODER, RANKS
from lendframe.session import materialise


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches `quality.ACCEPT`."""
    labels = read_table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id")))
    model = quality.fit(docs, labels)
    # As one struct, the columns of docs cannot clash with those of the score.
    packed = docs.select(F.struct(*docs.columns).alias("_document"), "text")
    return quality.score(packed, model, keep=("_document",)).where("predicted = 1").select("_document.*")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near duplicates (5 words, 0.8).

    Rows without a doc_id stay; of repeated rows of a kept document one stays.
    """
    found = minhash.near_duplicates(docs, width=5, percent=80)
    gone = found.where("NOT kept").select("doc_id").distinct()
    rest = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    named = rest.where("doc_id IS NOT NULL").dropDuplicates(["doc_id", "text"])
    return named.unionByName(rest.where("doc_id IS NULL"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, read_table(spark, sf_dir, "benchmark")).select(*docs.columns)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts replaced by a placeholder; n_chars follows."""
    clean = secret_scan.redact(docs, vocabulary_path(RANKS))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token ids, their count, and digests of ids and decoded text."""
    return bpe.encode_documents(docs, vocabulary_path(ENCODER))


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secret_stage),
    ("tokens", token_stage),
]

# Learned scores and similarity components have no SQL form; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
