"""spark-submit entry points: prepare, etl, train, evaluate and score.

spark-submit --py-files lendframe.zip lendframe/jobs/__main__.py train --data ... --out ...
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from lendframe.jobs import runs
from lendframe.operators.train import PATIENCE
from lendframe.session import tune


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="lendframe.jobs")
    parser.add_argument("job", choices=["prepare", "etl", "train", "evaluate", "score"])
    parser.add_argument("--data", required=True, help="raw loans: a path, or database.table for etl")
    parser.add_argument("--out", required=True, help="output folder")
    parser.add_argument("--model-name", default="loan_risk")
    parser.add_argument("--profile", default="gbt", choices=["gbt", "gbt_coded", "forest"])
    parser.add_argument("--as-of-year", type=int, required=True)
    parser.add_argument("--on-invalid", default="warn", choices=["warn", "raise"])
    parser.add_argument("--trials", type=int, default=0, help="search trials before training")
    parser.add_argument("--patience", type=int, default=PATIENCE, help="boosting rounds without gain before it stops")
    parser.add_argument("--threshold", type=float, default=None)
    a = parser.parse_args(argv)
    spark = tune(SparkSession.builder.appName(f"lendframe-{a.job}").getOrCreate())
    if a.job == "prepare":
        runs.prepare(spark, a.data, a.out, a.as_of_year, a.on_invalid)
    elif a.job == "etl":
        runs.etl(spark, a.data, a.out, a.as_of_year)
    elif a.job == "train":
        runs.train(spark, a.data, a.out, a.as_of_year, a.model_name, a.profile, a.trials, a.on_invalid, patience=a.patience)
    elif a.job == "evaluate":
        runs.evaluate(spark, a.data, a.out, a.model_name, a.threshold)
    else:
        runs.score(spark, a.data, a.out, a.model_name, a.threshold)


if __name__ == "__main__":
    main()
