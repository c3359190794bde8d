"""Registry of named features, and feature selection."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendframe.functions import ratios
from lendframe.operators.prepare import DEFAULT_YEAR
from lendframe.operators.profile import text_columns
from lendframe.operators.ranking import binned, number, quantile_cuts


@dataclass(frozen=True)
class Feature:
    """A column formula with the columns it reads."""

    name: str
    description: str
    formula: Callable[[], Column]
    dependencies: tuple[str, ...]
    version: str = "1.0.0"


class FeatureRegistry:
    def __init__(self, features: Sequence[Feature] = ()):
        self._features: dict[str, Feature] = {}
        for f in features:
            self.register(f)

    def register(self, feature: Feature) -> None:
        """A feature of the same name is replaced."""
        self._features[feature.name] = feature

    def create(self, df: DataFrame, names: Sequence[str] | None = None) -> tuple[DataFrame, dict[str, str]]:
        """(df with features, {skipped name: reason}).

        Features are added in the given order; one may read another that was added before it.
        """
        skipped: dict[str, str] = {}
        for name in names or list(self._features):
            feature = self._features.get(name)
            if feature is None:
                skipped[name] = "unknown feature"
                continue
            missing = [d for d in feature.dependencies if d not in df.columns]
            if missing:
                skipped[name] = f"missing columns: {', '.join(missing)}"
                continue
            df = df.withColumn(name, feature.formula())
        return df, skipped

    def rows(self) -> list[tuple[str, str, str, str]]:
        return [
            (f.name, f.description, ", ".join(f.dependencies), f.version)
            for f in self._features.values()
        ]

    def catalog(self, df: DataFrame) -> DataFrame:
        """(name, description, dependencies, version, rows, non_null) measured on `df`."""
        built, _ = self.create(df)
        layout = "name string, description string, dependencies string, version string"
        listed = df.sparkSession.createDataFrame(self.rows(), layout)
        present = [n for n in self._features if n in built.columns]
        packed = [
            F.struct(
                F.lit(n).alias("name"),
                F.count(F.lit(1)).alias("rows"),
                F.count(n).alias("non_null"),
            )
            for n in present
        ]
        measured = built.agg(F.array(*packed).alias("r")).select(F.explode("r").alias("r")).select("r.*")
        return listed.join(F.broadcast(measured), "name", "left")


def default_registry(as_of_year: int = DEFAULT_YEAR) -> FeatureRegistry:
    return FeatureRegistry(
        [
            Feature(
                "loan_to_income",
                "Loan amount over yearly income",
                ratios.loan_to_income,
                ("loan_amnt", "annual_inc"),
            ),
            Feature(
                "total_interest_owed",
                "Interest on the whole amount at the yearly rate",
                ratios.total_interest_owed,
                ("loan_amnt", "int_rate"),
            ),
            Feature(
                "installment_to_income_ratio",
                "Installment over monthly income",
                ratios.installment_to_income_ratio,
                ("installment", "annual_inc"),
            ),
            Feature(
                "active_credit_pct",
                "Open accounts over all accounts",
                ratios.active_credit_pct,
                ("open_acc", "total_acc"),
            ),
            Feature(
                "credit_age",
                "Years from the first credit line to the reference year",
                lambda: ratios.credit_age(as_of_year),
                ("earliest_cr_line",),
            ),
            Feature("dti_bucket", "Debt-to-income class", ratios.dti_bucket, ("dti",)),
            Feature("income_bucket", "Income class", ratios.income_bucket, ("annual_inc",)),
            Feature(
                "debt_burden_score",
                "Weighted sum of debt-to-income, card use and loan share",
                ratios.debt_burden_score,
                ("dti", "revol_util", "loan_amnt", "annual_inc"),
            ),
            Feature(
                "payment_capacity",
                "Share of monthly income left after the installment",
                ratios.payment_capacity,
                ("annual_inc", "installment"),
            ),
        ]
    )


def mutual_information(
    df: DataFrame, label: str, texts: Sequence[str] = (), numbers: Sequence[str] = (), bins: int = 10
) -> DataFrame:
    """(feature, importance): information in nats each feature carries about a 0/1 label, strongest first.

    Texts use their values as bins; numbers are cut at their exact quantiles, and a missing number
    counts as 0. Rows without a label are left out. The sum over cells only needs the totals of
    n ln n, so one aggregate per level is enough and nothing is joined.
    """
    rows = df.filter(F.col(label).isNotNull()).withColumns(
        {
            **{c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in texts},
            **{c: F.coalesce(number(c), F.lit(0.0)) for c in numbers},
        }
    )
    cuts = quantile_cuts(rows, numbers, bins) if numbers else None
    cells = (
        binned(rows, [label], texts, numbers, cuts, bins)
        .groupBy("feature", "bin")
        .agg(
            F.count_if(F.col(label) == 1).cast("double").alias("n1"),
            F.count_if(F.col(label) == 0).cast("double").alias("n0"),
        )
    )

    def n_ln_n(n: Column) -> Column:
        return F.when(n > 0, n * F.ln(n)).otherwise(F.lit(0.0))

    n1, n0 = F.col("n1"), F.col("n0")
    inner = cells.groupBy("feature").agg(
        F.sum(n_ln_n(n1) + n_ln_n(n0) - n_ln_n(n1 + n0)).alias("s"),
        F.sum("n1").alias("n1"),
        F.sum("n0").alias("n0"),
    )
    total = n1 + n0
    gain = F.try_divide(F.col("s") - n_ln_n(n1) - n_ln_n(n0) + n_ln_n(total), total)
    return inner.select("feature", gain.alias("importance")).orderBy(F.desc("importance"), "feature")


def strongest_features(df: DataFrame, label: str, columns: Sequence[str], k: int = 15) -> list[tuple[str, float]]:
    """(feature, information) of the k most informative columns; ties go to the first name."""
    texts = [c for c in columns if c in text_columns(df)]
    numbers = [c for c in columns if c not in texts]
    return [(r["feature"], r["importance"]) for r in mutual_information(df, label, texts, numbers).limit(k).collect()]


def select_features(
    df: DataFrame, label: str, columns: Sequence[str], k: int = 15, keep: Sequence[str] = ()
) -> tuple[DataFrame, list[str]]:
    """(df with the k most informative columns, their names); ties go to the first name."""
    names = [f for f, _ in strongest_features(df, label, columns, k)]
    return df.select(*keep, *names), names
