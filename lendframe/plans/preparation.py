"""Queries: scans, projections, filters, joins, cleaning rules, features, splits and encoding."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendframe.functions import cleaning, ratios
from lendframe.functions.records import flatten_struct
from lendframe.operators import encode, lookup, prepare, split
from lendframe.operators.features import default_registry
from lendframe.operators.prepare import PreparationEstimator, PreparationModel
from lendframe.operators.profile import schema_table, table_shape, target_mix
from lendframe.operators.ranking import exact_quantiles
from lendframe.operators.requests import check_requests
from lendframe.plans.catalog import (
    AS_OF_YEAR,
    EMP_NUMBER_SQL,
    EMP_TEXT_SQL,
    ETL_PARTS,
    HASH_SQL,
    LIBRARY,
    LINE_DATE_SQL,
    PREPARED_PARTS,
    RATIO_SQL,
    bin_sql,
    query,
)
from lendframe.plans.loans import loans, table
from lendframe.schema import CATEGORICAL, DROPPED, LOAN_SCHEMA, RAW_COLUMNS
from lendframe.session import materialise
from lendframe.sources.lake import lake_query


@lru_cache(maxsize=None)
def _learned(spark: SparkSession, sf_dir: str, dialect: str) -> PreparationModel:
    """Fitted once per table folder: what is learned does not depend on the options of `fitted`."""
    needed = ["total_acc", "mort_acc", "revol_util", "pub_rec_bankruptcies"]
    if dialect == "etl":
        needed += ["loan_status", "annual_inc"]
    return PreparationEstimator(AS_OF_YEAR, dialect).fit(loans(spark, sf_dir, needed))


def fitted(spark: SparkSession, sf_dir: str, dialect: str = "library", **options) -> PreparationModel:
    """Preparation fitted on all loans, as the checking SQL does."""
    model = _learned(spark, sf_dir, dialect)
    return PreparationModel(model.groups, model.groups_small, model.medians, AS_OF_YEAR, dialect, **options)


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fitted(spark, sf_dir).transform(loans(spark, sf_dir))


@lru_cache(maxsize=None)
def stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prepared loans as a written table, for queries that read them more than once."""
    return materialise(prepared(spark, sf_dir), "prepared")


@query("scan_loans", "SELECT * FROM loans")
def scan_loans(spark, sf_dir):
    return loans(spark, sf_dir)


@query(
    "lake_sql",
    "SELECT grade, count(*) AS n, round(avg(int_rate), 6) AS mean_rate FROM loans "
    "WHERE year(issue_d) = 1997 GROUP BY grade",
)
def lake_sql(spark, sf_dir):
    return lake_query(
        spark,
        "SELECT grade, count(*) AS n, round(avg(int_rate), 6) AS mean_rate FROM loans "
        "WHERE year(issue_d) = 1997 GROUP BY grade",
        {"loans": loans(spark, sf_dir, ["grade", "int_rate", "issue_d"])},
    )


@query("drop_columns", f"SELECT * EXCLUDE ({', '.join(DROPPED[1:])}) FROM loans")
def drop_columns(spark, sf_dir):
    return prepare.drop_unwanted(loans(spark, sf_dir))


@query("valid_status", "SELECT loan_id, loan_status FROM loans WHERE loan_status IN ('Fully Paid', 'Charged Off')")
def valid_status(spark, sf_dir):
    return prepare.valid_status(loans(spark, sf_dir, ["loan_id", "loan_status"]))


@query("positive_income", "SELECT loan_id, annual_inc FROM loans WHERE annual_inc > 0")
def positive_income(spark, sf_dir):
    return prepare.positive_income(loans(spark, sf_dir, ["loan_id", "annual_inc"]))


_KEPT = [c for c in RAW_COLUMNS if c not in DROPPED]


@query(
    "drop_null_rows",
    f"SELECT {', '.join(_KEPT)} FROM loans WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in _KEPT),
)
def drop_null_rows(spark, sf_dir):
    return prepare.drop_unwanted(loans(spark, sf_dir)).na.drop("any")


@query("drop_null_subset", "SELECT loan_id, revol_util, loan_status FROM loans WHERE revol_util IS NOT NULL")
def drop_null_subset(spark, sf_dir):
    return loans(spark, sf_dir, ["loan_id", "revol_util", "loan_status"]).na.drop(subset=["revol_util"])


@query("prepared_loans", "SELECT * FROM prepared", PREPARED_PARTS)
def prepared_loans(spark, sf_dir):
    return prepared(spark, sf_dir)


@query(
    "rejected_loans",
    "SELECT loan_id FROM loans WHERE loan_id NOT IN (SELECT loan_id FROM prepared)",
    PREPARED_PARTS,
)
def rejected_loans(spark, sf_dir):
    return fitted(spark, sf_dir).rejected(loans(spark, sf_dir)).select("loan_id")


@query("etl_loans", "SELECT * FROM etl", (*ETL_PARTS, "etl"))
def etl_loans(spark, sf_dir):
    return fitted(spark, sf_dir, "etl").transform(loans(spark, sf_dir))


@query("etl_metadata")
def etl_metadata(spark, sf_dir):
    return prepare.add_metadata(etl_loans(spark, sf_dir), "loan-etl")


_INSPECTED = ["revol_util", "pub_rec_bankruptcies", "emp_length"]


@query(
    "null_subset_target",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, loan_status, count(*) AS n FROM loans WHERE {c} IS NULL GROUP BY loan_status"
        for c in _INSPECTED
    ),
)
def null_subset_target(spark, sf_dir):
    counted = (
        loans(spark, sf_dir, ["loan_status", *_INSPECTED])
        .groupBy("loan_status")
        .agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in _INSPECTED])
    )
    return counted.unpivot(["loan_status"], _INSPECTED, "column_name", "n").filter("n > 0")


@query(
    "missing_indicator",
    "SELECT loan_id, CAST(mort_acc IS NULL AS INTEGER) AS mort_acc_missing FROM loans",
)
def missing_indicator(spark, sf_dir):
    rows = loans(spark, sf_dir, ["loan_id", "mort_acc"])
    return rows.select("loan_id", F.col("mort_acc").isNull().cast("int").alias("mort_acc_missing"))


@query(
    "encode_target",
    "SELECT loan_id, CASE loan_status WHEN 'Fully Paid' THEN 1 WHEN 'Charged Off' THEN 0 END AS target FROM loans",
)
def encode_target(spark, sf_dir):
    rows = loans(spark, sf_dir, ["loan_id", "loan_status"])
    return rows.select("loan_id", cleaning.target_code(F.col("loan_status")).alias("target"))


@query(
    "high_income",
    "SELECT loan_id, annual_inc, loan_status FROM loans "
    "WHERE annual_inc >= (SELECT quantile_cont(annual_inc, 0.99) FROM loans)",
)
def high_income(spark, sf_dir):
    rows = loans(spark, sf_dir, ["loan_id", "annual_inc", "loan_status"])
    cut = exact_quantiles(rows, ["annual_inc"], [0.99]).select("q0").scalar()
    return rows.withColumn("_cut", cut).filter("annual_inc >= _cut").drop("_cut")


@query("table_shape", f"SELECT count(*) AS rows, {len(RAW_COLUMNS)} AS columns FROM loans")
def shape(spark, sf_dir):
    return table_shape(loans(spark, sf_dir))


@query(
    "table_schema",
    " UNION ALL ".join(
        f"SELECT {i} AS position, '{f.name}' AS \"column\", '{f.dataType.simpleString()}' AS type, "
        f"count({f.name}) AS non_null FROM loans"
        for i, f in enumerate(LOAN_SCHEMA)
    ),
)
def schema_of_loans(spark, sf_dir):
    return schema_table(loans(spark, sf_dir))


@query(
    "request_check",
    "SELECT loan_id, concat_ws(', ', CASE WHEN annual_inc IS NULL OR annual_inc < 0 THEN 'annual_inc' END) "
    "AS bad_fields FROM loans WHERE annual_inc IS NULL OR annual_inc < 0",
)
def request_check(spark, sf_dir):
    _, refused = check_requests(loans(spark, sf_dir))
    return refused.select("loan_id", F.array_join("reasons", ", ").alias("bad_fields"))


@query(
    "target_distribution",
    "SELECT loan_status, count(*) AS n, round(count(*) * 1e2 / (SELECT count(*) FROM loans), 6) AS percent "
    "FROM loans GROUP BY loan_status",
)
def target_distribution(spark, sf_dir):
    mix = target_mix(loans(spark, sf_dir, ["loan_status"]), "loan_status")
    return mix.withColumn("percent", F.round("percent", 6))


# Joins


@query("impute_mort_acc", "SELECT loan_id, total_acc, mort_acc FROM filled", LIBRARY)
def impute_mort_acc(spark, sf_dir):
    rows = loans(spark, sf_dir, ["loan_id", "total_acc", "mort_acc"])
    return fitted(spark, sf_dir).imputed(rows).select("loan_id", "total_acc", "mort_acc")


@query("impute_mort_acc_etl", "SELECT loan_id, total_acc, mort_acc FROM etl_filled", ETL_PARTS)
def impute_mort_acc_etl(spark, sf_dir):
    names = ["loan_id", "total_acc", "mort_acc", "emp_length", "loan_status", "annual_inc"]
    rows = prepare.positive_income(prepare.valid_status(loans(spark, sf_dir, names)))
    return fitted(spark, sf_dir, "etl").imputed(rows).select("loan_id", "total_acc", "mort_acc")


@query(
    "impute_medians",
    "SELECT loan_id, revol_util, pub_rec_bankruptcies FROM filled",
    LIBRARY,
)
def impute_medians(spark, sf_dir):
    rows = loans(spark, sf_dir, ["loan_id", "revol_util", "pub_rec_bankruptcies"])
    return prepare.fill_medians(rows, fitted(spark, sf_dir).medians, ["revol_util", "pub_rec_bankruptcies"])


@query(
    "split_membership",
    f"SELECT loan_id, loan_status, CASE WHEN ({HASH_SQL}) % 100 < 20 THEN 'test' ELSE 'train' END AS member_of "
    "FROM loans",
)
def split_membership(spark, sf_dir):
    rows = loans(spark, sf_dir, ["loan_id", "loan_status"])
    test_ids = split.with_split(loans(spark, sf_dir, ["loan_id"])).filter("split = 'test'")
    inside, outside = lookup.split_by_ids(rows, test_ids, "loan_id")
    return inside.withColumn("member_of", F.lit("test")).unionByName(
        outside.withColumn("member_of", F.lit("train"))
    )


@query(
    "exact_split",
    "SELECT loan_id, loan_status, CASE WHEN place <= (40 * size + 100) // 200 THEN 'test' ELSE 'train' END AS split FROM ("
    f"SELECT loan_id, loan_status, row_number() OVER (PARTITION BY loan_status ORDER BY {HASH_SQL}, CAST(loan_id AS VARCHAR)) "
    "AS place, count(*) OVER (PARTITION BY loan_status) AS size FROM loans) x",
)
def exact_split(spark, sf_dir):
    """Every loan with its side of a split that holds a fifth of each status to the row."""
    return split.exact_split(loans(spark, sf_dir, ["loan_id", "loan_status"]), "loan_status")


# Cleaning rules, one per query


def _expression(name: str, sql: str, columns: list[str], expression, parts=("loans",)) -> None:
    """A row-level rule: loan_id and one computed column."""

    @query(name, f"SELECT loan_id, {sql} AS value FROM loans", parts)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        built: Column = expression()
        return loans(spark, sf_dir, ["loan_id", *columns]).select("loan_id", built.alias("value"))


_expression("emp_length_text", EMP_TEXT_SQL, ["emp_length"], lambda: cleaning.emp_length_text(F.col("emp_length")))
_expression("emp_length_numeric", EMP_NUMBER_SQL, ["emp_length"], lambda: cleaning.emp_length_number(F.col("emp_length")))
_expression("bin_pub_rec", bin_sql("pub_rec"), ["pub_rec"], lambda: cleaning.zero_one_more(F.col("pub_rec")))
_expression(
    "bin_bankruptcies",
    bin_sql("coalesce(pub_rec_bankruptcies, 0)"),
    ["pub_rec_bankruptcies"],
    lambda: cleaning.bankruptcy_bin(F.col("pub_rec_bankruptcies")),
)
_expression("parse_credit_line", LINE_DATE_SQL, ["earliest_cr_line"], lambda: cleaning.credit_line_date(F.col("earliest_cr_line")))
_expression("fill_unknown", "coalesce(emp_length, 'Unknown')", ["emp_length"], lambda: F.coalesce("emp_length", F.lit(cleaning.UNKNOWN)))
_expression("feat_loan_to_income", RATIO_SQL["loan_to_income"], ["loan_amnt", "annual_inc"], ratios.loan_to_income)
_expression("feat_total_interest", RATIO_SQL["total_interest_owed"], ["loan_amnt", "int_rate"], ratios.total_interest_owed)
_expression("feat_installment_ratio", RATIO_SQL["installment_to_income_ratio"], ["installment", "annual_inc"], ratios.installment_to_income_ratio)
_expression("feat_active_credit", RATIO_SQL["active_credit_pct"], ["open_acc", "total_acc"], ratios.active_credit_pct)
_expression("feat_credit_age", RATIO_SQL["credit_age"], ["earliest_cr_line"], lambda: ratios.credit_age(AS_OF_YEAR))

_DTI_SQL = (
    "CASE WHEN dti > 0 AND dti <= 10 THEN 'very_low' WHEN dti > 10 AND dti <= 20 THEN 'low' "
    "WHEN dti > 20 AND dti <= 30 THEN 'medium' WHEN dti > 30 AND dti <= 40 THEN 'high' "
    "WHEN dti > 40 AND dti <= 100 THEN 'very_high' END"
)
_INCOME_SQL = (
    "CASE WHEN annual_inc > 0 AND annual_inc <= 30000 THEN 'very_low' WHEN annual_inc > 30000 AND annual_inc <= 50000 "
    "THEN 'low' WHEN annual_inc > 50000 AND annual_inc <= 75000 THEN 'medium' WHEN annual_inc > 75000 AND "
    "annual_inc <= 100000 THEN 'high' WHEN annual_inc > 100000 AND annual_inc <= 150000 THEN 'very_high' "
    "WHEN annual_inc > 150000 THEN 'top' END"
)
_BURDEN_SQL = (
    "dti * 3e-1 + coalesce(revol_util, 0e0) * 3e-1 + (loan_amnt / nullif(annual_inc, 0)) * 1e2 * 4e-1"
)
_CAPACITY_SQL = "(annual_inc / 12e0 - installment) / nullif(annual_inc / 12e0 + 1e0, 0)"
_expression("feat_dti_bucket", _DTI_SQL, ["dti"], ratios.dti_bucket)
_expression("feat_income_bucket", _INCOME_SQL, ["annual_inc"], ratios.income_bucket)
_expression("feat_debt_burden", _BURDEN_SQL, ["dti", "revol_util", "loan_amnt", "annual_inc"], ratios.debt_burden_score)
_expression("feat_payment_capacity", _CAPACITY_SQL, ["annual_inc", "installment"], ratios.payment_capacity)

_ALL_FEATURES = {
    **RATIO_SQL,
    "dti_bucket": _DTI_SQL,
    "income_bucket": _INCOME_SQL,
    "debt_burden_score": _BURDEN_SQL,
    "payment_capacity": _CAPACITY_SQL,
}


@query(
    "all_features",
    "SELECT loan_id, " + ", ".join(f"{sql} AS {name}" for name, sql in _ALL_FEATURES.items()) + " FROM loans",
)
def all_features(spark, sf_dir):
    registry = default_registry(AS_OF_YEAR)
    built, _ = registry.create(loans(spark, sf_dir))
    return built.select("loan_id", *_ALL_FEATURES)


@query(
    "feature_catalog",
    " UNION ALL ".join(
        f"SELECT '{n}' AS name, '{deps}' AS dependencies, '{version}' AS version, count(*) AS rows, "
        f"count({_ALL_FEATURES[n]}) AS non_null FROM loans"
        for n, _, deps, version in default_registry(AS_OF_YEAR).rows()
    ),
)
def feature_catalog(spark, sf_dir):
    return default_registry(AS_OF_YEAR).catalog(loans(spark, sf_dir)).drop("description")


@query(
    "flatten_struct",
    "SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS \"props.k\" FROM events",
    (),
)
def flatten(spark, sf_dir):
    nested = table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.from_json("props", "k bigint").alias("props")
    )
    return flatten_struct(nested)


# Splits and encoding


@query(
    "train_test_split",
    f"SELECT loan_status, CASE WHEN ({HASH_SQL}) % 100 < 20 THEN 'test' ELSE 'train' END AS split, count(*) AS n "
    "FROM loans GROUP BY ALL",
)
def train_test_split(spark, sf_dir):
    rows = split.with_split(loans(spark, sf_dir, ["loan_id", "loan_status"]))
    return rows.groupBy("loan_status", "split").agg(F.count(F.lit(1)).alias("n"))


@query(
    "fold_counts",
    f"SELECT loan_status, CAST(({HASH_SQL}) % 5 AS INTEGER) AS fold, count(*) AS n FROM loans GROUP BY ALL",
)
def fold_counts(spark, sf_dir):
    rows = split.with_fold(loans(spark, sf_dir, ["loan_id", "loan_status"]))
    return rows.groupBy("loan_status", "fold").agg(F.count(F.lit(1)).alias("n"))


@query(
    "sample_rows",
    f"SELECT loan_id, loan_status FROM loans ORDER BY {HASH_SQL}, loan_id LIMIT 1000",
)
def sample(spark, sf_dir):
    return split.sample_rows(loans(spark, sf_dir, ["loan_id", "loan_status"]), 1000)


@query(
    "class_weights",
    "SELECT count(*) FILTER (WHERE loan_status = 'Fully Paid') AS pos, "
    "count(*) FILTER (WHERE loan_status = 'Charged Off') AS neg, "
    "CAST(count(*) FILTER (WHERE loan_status = 'Charged Off') AS DOUBLE) / "
    "count(*) FILTER (WHERE loan_status = 'Fully Paid') AS scale_pos_weight FROM loans",
)
def class_weights(spark, sf_dir):
    rows = loans(spark, sf_dir, ["loan_status"])
    return split.class_weights(rows.select(cleaning.target_code(F.col("loan_status")).alias("label")))


_LONG_CATEGORIES = " UNION ALL ".join(
    f"SELECT loan_id, '{c}' AS \"column\", {c} AS value FROM prepared" for c in CATEGORICAL
)
_VOCABULARY = (
    f"WITH long AS ({_LONG_CATEGORIES}), vocab AS (SELECT \"column\", value, "
    "CAST(row_number() OVER (PARTITION BY \"column\" ORDER BY value) - 1 AS INTEGER) AS code "
    "FROM (SELECT DISTINCT \"column\", value FROM long) d) "
)


@query("vocabulary", _VOCABULARY + "SELECT * FROM vocab", PREPARED_PARTS)
def vocabulary(spark, sf_dir):
    return encode.vocabulary(stored(spark, sf_dir), CATEGORICAL)


@query(
    "label_encode",
    _VOCABULARY
    + "SELECT loan_id, "
    + ", ".join(f"max(code) FILTER (WHERE \"column\" = '{c}') AS {c}_code" for c in CATEGORICAL)
    + " FROM long JOIN vocab USING (\"column\", value) GROUP BY loan_id",
    PREPARED_PARTS,
)
def label_encode(spark, sf_dir):
    rows = stored(spark, sf_dir)
    coded = encode.code_by_table(rows, materialise(encode.vocabulary(rows, CATEGORICAL), "vocabulary"), CATEGORICAL)
    return coded.select("loan_id", *[f"{c}_code" for c in CATEGORICAL])


@query(
    "default_rate_by_grade",
    "SELECT grade, count(*) AS n, round(avg(int_rate), 6) AS mean_rate, "
    "round(avg(CASE loan_status WHEN 'Charged Off' THEN 1e0 WHEN 'Fully Paid' THEN 0e0 END), 6) AS default_rate "
    "FROM prepared GROUP BY grade",
    PREPARED_PARTS,
)
def default_rate_by_grade(spark, sf_dir):
    """Flagship: how often each grade defaults, over the prepared table."""
    rows = prepared(spark, sf_dir)
    repaid = cleaning.target_code(F.col("loan_status")).cast("double")
    return rows.groupBy("grade").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg("int_rate"), 6).alias("mean_rate"),
        F.round(F.avg(F.lit(1.0) - repaid), 6).alias("default_rate"),
    )
