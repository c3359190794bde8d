"""Rows that are kept while trees grow lie in partitions of bounded size."""

from pyspark.sql import functions as F

from lendframe.operators import train
from lendframe.schema import CATEGORICAL, NUMERIC


def test_encoded_rows_are_dealt_to_partitions_of_bounded_size(spark, monkeypatch):
    texts = [F.concat(F.lit("t"), (F.col("id") % 3).cast("string")).alias(c) for c in CATEGORICAL]
    rows = spark.range(0, 1000, 1, 1).select("id", *texts, *[F.col("id").cast("double").alias(c) for c in NUMERIC], (F.col("id") % 2).cast("double").alias("label"))
    assert train.encode_rows(rows, "gbt", ["id"])[1].rdd.getNumPartitions() == 1
    monkeypatch.setattr(train, "PART_ROWS", 200)
    encoded = train.encode_rows(rows, "gbt", ["id"])[1]
    sizes = [r.n for r in encoded.groupBy(F.spark_partition_id()).agg(F.count("id").alias("n")).collect()]
    assert len(sizes) == 5 and max(sizes) <= 400
    assert sorted(r.id for r in encoded.select("id").collect()) == list(range(1000))
