"""Scoring of prepared loans; the same plan serves tables and streams."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendframe.operators.prepare import PreparationModel
from lendframe.operators.requests import check_requests
from lendframe.operators.train import LoanModel
from lendframe.schema import ID

DEFAULT_THRESHOLD = 0.5
# Bounds of the three risk tiers on the probability of default.
LOW_RISK, MEDIUM_RISK = 0.2, 0.5


def with_probability(model: LoanModel, prepared: DataFrame) -> DataFrame:
    """Add `p_repaid`; the model's working columns are dropped."""
    scored = model.transform(prepared)
    return scored.withColumn("p_repaid", vector_to_array("probability")[1]).select(
        *prepared.columns, "p_repaid"
    )


def default_risk(prediction: Column) -> Column:
    return F.when(prediction == 1, "Low").otherwise("High")


def risk_level(p_default: Column) -> Column:
    return F.when(p_default < LOW_RISK, "Low").when(p_default < MEDIUM_RISK, "Medium").otherwise("High")


def score(
    model: LoanModel,
    prepared: DataFrame,
    threshold: float = DEFAULT_THRESHOLD,
    model_version: str | None = None,
) -> DataFrame:
    """(loan_id, prediction, p_repaid, p_default, default_risk, risk_level, confidence, threshold, ...).

    `prediction` is 1 when the probability of repayment reaches the threshold; any threshold counts,
    0 included.
    """
    p = F.col("p_repaid")
    rows = with_probability(model, prepared)
    prediction = F.when(p >= float(threshold), 1).otherwise(0)
    return rows.select(
        ID,
        prediction.alias("prediction"),
        p,
        (1 - p).alias("p_default"),
        default_risk(prediction).alias("default_risk"),
        risk_level(1 - p).alias("risk_level"),
        F.greatest(p, 1 - p).alias("confidence"),
        F.lit(float(threshold)).alias("threshold"),
        F.lit(model_version).cast("string").alias("model_version"),
    )


class Scorer:
    """Preparation and model together, as loaded from a registry."""

    def __init__(
        self,
        preparation: PreparationModel,
        model: LoanModel,
        threshold: float = DEFAULT_THRESHOLD,
        model_version: str | None = None,
    ):
        self.preparation = preparation
        self.model = model
        self.threshold = threshold
        self.model_version = model_version

    def set_threshold(self, threshold: float) -> None:
        self.threshold = float(threshold)

    def score(self, raw: DataFrame) -> DataFrame:
        """Scores of raw rows; rows preparation cannot use are in `rejected`, not lost."""
        prepared = self.preparation.transform(raw)
        return score(self.model, prepared, self.threshold, self.model_version)

    def rejected(self, raw: DataFrame) -> DataFrame:
        return self.preparation.rejected(raw)

    def score_requests(self, raw: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(scores, refused rows with reasons): every row is in one of the two."""
        accepted, _ = check_requests(raw)
        return self.score(accepted), self.refused(raw)

    def refused(self, raw: DataFrame) -> DataFrame:
        """(loan_id, stage, reasons): rows out of bounds, and those within that preparation cannot use."""
        accepted, outside = check_requests(raw)
        bounds = outside.select(ID, F.lit("bounds").alias("stage"), "reasons")
        unusable = self.preparation.rejected(accepted)
        return bounds.unionByName(unusable.select(ID, F.lit("preparation").alias("stage"), "reasons"))

    def outcomes(self, raw: DataFrame) -> DataFrame:
        """(loan_id, outcome, stage): one row per request, `scored` or `refused`."""
        scored, refused = self.score_requests(raw)
        done = scored.select(ID, F.lit("scored").alias("outcome"), F.lit(None).cast("string").alias("stage"))
        return done.unionByName(refused.select(ID, F.lit("refused").alias("outcome"), "stage"))


def prediction_mix(scored: DataFrame) -> DataFrame:
    """(prediction, n, percent)."""
    counted = scored.groupBy("prediction").agg(F.count(F.lit(1)).alias("n"))
    total = counted.agg(F.sum("n")).scalar()
    return counted.withColumn("_t", total).select(
        "prediction", "n", (F.col("n") * 100.0 / F.col("_t")).alias("percent")
    )
