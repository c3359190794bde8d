"""Cleaning, imputation and feature derivation as a Spark ML estimator.

`PreparationEstimator.fit` reads the training rows once and keeps three small pieces of state: the
median of `mort_acc` per `total_acc`, one median per filled column, and nothing else.
`PreparationModel.transform` is a lazy plan of joins and expressions, so the same object serves
batch tables and streams.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.base import Estimator, Model
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendframe.functions import cleaning, ratios
from lendframe.operators.lookup import attach
from lendframe.operators.ranking import exact_quantiles
from lendframe.schema import (
    DROPPED,
    ETL_DROPPED,
    ID,
    MEDIAN_FILLED,
    PREPARED,
    TARGET,
    TARGET_CODES,
)
from lendframe.session import local_copy, materialise

DEFAULT_YEAR = 2025
# Columns that may not be missing in a kept row once medians are filled in. The
# amounts are not results themselves, but a result derived from them would be missing.
_PLAIN = [
    "loan_amnt",
    "term",
    "int_rate",
    "installment",
    "grade",
    "home_ownership",
    "verification_status",
    "purpose",
    "dti",
    "open_acc",
    "revol_util",
    "initial_list_status",
    "mort_acc",
]


def drop_unwanted(df: DataFrame, columns: Sequence[str] = DROPPED) -> DataFrame:
    """Absent columns are ignored."""
    return df.drop(*columns)


def valid_status(df: DataFrame) -> DataFrame:
    return df.filter(F.col(TARGET).isin(*TARGET_CODES))


def positive_income(df: DataFrame) -> DataFrame:
    return df.filter(F.col("annual_inc") > 0)


def median_histogram(df: DataFrame) -> DataFrame:
    """(key, column, value, n): counts behind every fitted median, gathered in one pass.

    `mort_acc` is counted per `total_acc`; rows where it is missing stay, as proof that the key is
    known.
    """
    present = [c for c in MEDIAN_FILLED if c in df.columns]
    key = F.when(F.col("column") == "mort_acc", F.col("total_acc"))
    return (
        df.select(*[F.col(c).cast("double").alias(c) for c in ["total_acc", *present]])
        .unpivot(["total_acc"], present, "column", "value")
        .groupBy(key.alias("key"), "column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def fill_mort_acc(
    df: DataFrame, medians: DataFrame, default: float | None, small: bool
) -> DataFrame:
    """Missing `mort_acc` becomes its group's median; `default` only where the group is unknown."""
    table = medians.select("total_acc", F.struct("median").alias("_group"))
    joined = attach(df, table, "total_acc", small)
    found = F.when(F.col("_group").isNotNull(), F.col("_group.median")).otherwise(
        F.lit(default).cast("double")
    )
    return joined.withColumn("mort_acc", F.coalesce(F.col("mort_acc"), found)).drop("_group")


def fill_medians(df: DataFrame, medians: dict[str, float | None], columns: Sequence[str]) -> DataFrame:
    fills = {c: medians.get(c) for c in columns if c in df.columns and medians.get(c) is not None}
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fills.items()})


class PreparationModel(Model):
    """Fitted preparation; `transform` keeps the row key when the input has one."""

    def __init__(
        self,
        groups: DataFrame,
        groups_small: bool,
        medians: dict[str, float | None],
        as_of_year: int = DEFAULT_YEAR,
        dialect: str = "library",
        include_target: bool = True,
        strict: bool = True,
    ):
        super().__init__()
        self.groups = groups
        self.groups_small = groups_small
        self.medians = medians
        self.as_of_year = as_of_year
        self.dialect = dialect
        self.include_target = include_target
        self.strict = strict

    def imputed(self, df: DataFrame) -> DataFrame:
        """Missing numbers filled with the fitted medians."""
        df = cleaning.null_if_nan(df)
        etl = self.dialect == "etl"
        default = None if etl else self.medians.get("mort_acc")
        if "mort_acc" in df.columns:
            df = fill_mort_acc(df, self.groups, default, self.groups_small)
        df = fill_medians(df, self.medians, ["revol_util", "pub_rec_bankruptcies"])
        return df.fillna({"emp_length": cleaning.UNKNOWN}) if etl else df

    def _filled(self, df: DataFrame) -> DataFrame:
        return self.imputed(drop_unwanted(df, ETL_DROPPED if self.dialect == "etl" else DROPPED))

    def _complete(self, df: DataFrame) -> dict[str, Column]:
        """What a kept row must satisfy, by reason, over the filled but not yet derived columns.

        "No NULL in any result column" is stated on the inputs, so the simple tests reach the scan
        and no derived expression is evaluated twice for the filter.
        """
        present = set(df.columns)
        checks = {"annual_inc not positive": F.col("annual_inc") > 0}
        plain = [*_PLAIN, *([TARGET] if self.include_target else [])]
        for c in plain:
            if c in present:
                checks[f"{c} missing"] = F.col(c).isNotNull()
        if "total_acc" in present:
            checks["total_acc not positive"] = F.col("total_acc") > 0
        if "earliest_cr_line" in present:
            date = cleaning.credit_line_date(F.col("earliest_cr_line"))
            checks["earliest_cr_line unreadable"] = date.isNotNull()
        if self.dialect == "etl":
            if TARGET in present:
                checks["loan_status not final"] = F.col(TARGET).isin(*TARGET_CODES)
            if "emp_length" in present:
                years = cleaning.emp_length_number(F.col("emp_length"))
                checks["emp_length unreadable"] = years.isNotNull()
        return checks

    def _derive(self, df: DataFrame) -> DataFrame:
        etl = self.dialect == "etl"
        length = cleaning.emp_length_number if etl else cleaning.emp_length_text
        bankruptcies = cleaning.zero_one_more if etl else cleaning.bankruptcy_bin
        steps = {
            "emp_length": (("emp_length",), length(F.col("emp_length"))),
            "pub_rec": (("pub_rec",), cleaning.zero_one_more(F.col("pub_rec"))),
            "pub_rec_bankruptcies": (
                ("pub_rec_bankruptcies",),
                bankruptcies(F.col("pub_rec_bankruptcies")),
            ),
            "loan_to_income": (("loan_amnt", "annual_inc"), ratios.loan_to_income()),
            "total_interest_owed": (("loan_amnt", "int_rate"), ratios.total_interest_owed()),
            "installment_to_income_ratio": (
                ("installment", "annual_inc"),
                ratios.installment_to_income_ratio(),
            ),
            "active_credit_pct": (("open_acc", "total_acc"), ratios.active_credit_pct()),
            "credit_age": (("earliest_cr_line",), ratios.credit_age(self.as_of_year)),
        }
        present = set(df.columns)
        return df.withColumns({n: e for n, (needs, e) in steps.items() if present.issuperset(needs)})

    def _selected(self, df: DataFrame) -> list[str]:
        names = [*PREPARED, *([TARGET] if self.include_target else [])]
        missing = [c for c in names if c not in df.columns]
        if missing and self.strict:
            raise ValueError(f"missing columns: {missing}")
        return [*([ID] if ID in df.columns else []), *[c for c in names if c in df.columns]]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        # On the raw columns these tests reach the scan; NaN passes them and is caught below.
        for c in dataset.columns:
            if c in ("annual_inc", "total_acc"):
                dataset = dataset.filter(F.col(c) > 0)
            elif c in _PLAIN and c not in MEDIAN_FILLED:
                dataset = dataset.filter(F.col(c).isNotNull())
        rows = self._filled(dataset)
        for ok in self._complete(rows).values():
            rows = rows.filter(ok)
        rows = self._derive(rows)
        return rows.select(*self._selected(rows))

    def rejected(self, df: DataFrame) -> DataFrame:
        """(loan_id, reasons): rows `transform` leaves out, with every reason."""
        rows = self._filled(df)
        checks = [
            F.when(~F.coalesce(ok, F.lit(False)), F.lit(reason))
            for reason, ok in self._complete(rows).items()
        ]
        reasons = F.array_compact(F.array(*checks))
        return rows.select(ID, reasons.alias("reasons")).filter(F.size("reasons") > 0)

    def save(self, path: str) -> None:
        spark = self.groups.sparkSession
        self.groups.write.mode("overwrite").parquet(f"{path}/groups")
        state = [(c, self.medians.get(c)) for c in MEDIAN_FILLED]
        spark.createDataFrame(state, "column string, median double").write.mode(
            "overwrite"
        ).parquet(f"{path}/medians")
        options = [
            (self.as_of_year, self.dialect, self.include_target, self.strict, self.groups_small)
        ]
        layout = (
            "as_of_year int, dialect string, include_target boolean, strict boolean, small boolean"
        )
        spark.createDataFrame(options, layout).write.mode("overwrite").parquet(f"{path}/options")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "PreparationModel":
        o = spark.read.parquet(f"{path}/options").first()
        medians = {r["column"]: r["median"] for r in spark.read.parquet(f"{path}/medians").collect()}
        groups = spark.read.parquet(f"{path}/groups")
        if o["small"]:
            groups = local_copy(groups)
        return PreparationModel(
            groups, o["small"], medians, o["as_of_year"], o["dialect"], o["include_target"], o["strict"]
        )


class PreparationEstimator(Estimator):
    """Learns the medians. `dialect="etl"` filters first and uses lower medians, never averaged."""

    def __init__(
        self,
        as_of_year: int = DEFAULT_YEAR,
        dialect: str = "library",
        include_target: bool = True,
        strict: bool = True,
    ):
        super().__init__()
        if dialect not in ("library", "etl"):
            raise ValueError(f"unknown dialect: {dialect}")
        self.as_of_year = as_of_year
        self.dialect = dialect
        self.include_target = include_target
        self.strict = strict

    def _fit(self, dataset: DataFrame) -> PreparationModel:
        rows = cleaning.null_if_nan(dataset)
        if self.dialect == "etl":
            rows = positive_income(valid_status(rows))
            groups, small, medians = self._fit_lower(rows)
        else:
            groups, small, medians = self._fit_exact(rows)
        return PreparationModel(
            groups, small, medians, self.as_of_year, self.dialect, self.include_target, self.strict
        )

    @staticmethod
    def _keep(table: DataFrame, label: str) -> tuple[DataFrame, bool]:
        """(table, small): a local relation when it is small, else files in the shared folder."""
        copy = local_copy(table)
        return (copy, True) if copy is not None else (materialise(table, label), False)

    def _fit_exact(self, rows: DataFrame) -> tuple[DataFrame, bool, dict[str, float | None]]:
        hist = local_copy(median_histogram(rows))
        if hist is None:
            return self._fit_large(rows)
        half = F.percentile("value", 0.5, F.col("n"))
        found = (
            hist.groupingSets([["column", "key"], ["column"]], "column", "key")
            .agg(half.alias("median"), F.grouping("key").alias("whole"))
            .collect()
        )
        medians = {r["column"]: r["median"] for r in found if r["whole"]}
        known = [
            (r["key"], r["median"])
            for r in found
            if not r["whole"] and r["column"] == "mort_acc" and r["key"] is not None
        ]
        groups = rows.sparkSession.createDataFrame(known, "total_acc double, median double")
        return groups, True, medians

    def _fit_large(self, rows: DataFrame) -> tuple[DataFrame, bool, dict[str, float | None]]:
        """The same state when there are too many distinct values to finish from a local copy."""
        filled = [c for c in MEDIAN_FILLED if c in rows.columns]
        keyed = exact_quantiles(rows, ["mort_acc"], [0.5], ["total_acc"])
        known = rows.filter("total_acc IS NOT NULL").select("total_acc").distinct()
        table = known.join(keyed, "total_acc", "left").select("total_acc", F.col("q0").alias("median"))
        groups, small = self._keep(table, "medians")
        found = exact_quantiles(rows, filled, [0.5]).collect()
        return groups, small, {r["column"]: r["q0"] for r in found}

    def _fit_lower(self, rows: DataFrame) -> tuple[DataFrame, bool, dict[str, float | None]]:
        """Lower medians from mergeable summaries, in one aggregate each."""
        table = (
            rows.filter("total_acc IS NOT NULL")
            .groupBy("total_acc")
            .agg(F.percentile_approx("mort_acc", 0.5, 10000).alias("median"))
        )
        groups, small = self._keep(table, "medians")
        filled = [c for c in ("revol_util", "pub_rec_bankruptcies") if c in rows.columns]
        if not filled:
            return groups, small, {}
        found = rows.agg(
            *[F.percentile_approx(c, 0.5, 10000).alias(c) for c in filled]
        ).first()
        return groups, small, found.asDict()


def add_metadata(df: DataFrame, job_name: str) -> DataFrame:
    return df.withColumns(
        {"etl_timestamp": F.current_timestamp(), "etl_job_name": F.lit(job_name)}
    )
