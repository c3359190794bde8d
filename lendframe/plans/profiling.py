"""Queries: aggregations, profiling, validation, drift and feature selection."""

from __future__ import annotations

from itertools import combinations, permutations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendframe.functions import cleaning
from lendframe.functions.records import fingerprint
from lendframe.operators import drift, encode, features, neighbours, profile, quality, sketches
from lendframe.operators.ranking import approx_quantiles, exact_quantiles
from lendframe.plans.catalog import ETL_PARTS, PREPARED_PARTS, query
from lendframe.plans.loans import loans
from lendframe.plans.preparation import etl_loans, stored
from lendframe.schema import CATEGORICAL, LOAN_RULES, LOAN_SCHEMA, NUMERIC, RAW_COLUMNS
from lendframe.session import local_copy, materialise, work_path

_RAW_NUMBERS = [f.name for f in LOAN_SCHEMA if f.dataType.typeName() == "double"]
_RAW_TEXTS = [f.name for f in LOAN_SCHEMA if f.dataType.typeName() == "string"]


def _long(columns: list[str], source: str = "loans", keep: str = "", null: bool = False) -> str:
    """SQL: several columns as ("column", value) rows."""
    head = f"{keep}, " if keep else ""
    tail = "" if null else " WHERE {c} IS NOT NULL"
    return " UNION ALL ".join(
        f"SELECT {head}'{c}' AS \"column\", {c} AS value FROM {source}" + tail.format(c=c) for c in columns
    )


def _rounded(df: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query(
    "group_median",
    "SELECT total_acc, median(mort_acc) AS median FROM loans WHERE total_acc IS NOT NULL GROUP BY total_acc "
    "HAVING count(mort_acc) > 0",
)
def group_median(spark, sf_dir):
    rows = loans(spark, sf_dir, ["total_acc", "mort_acc"])
    found = exact_quantiles(rows, ["mort_acc"], [0.5], ["total_acc"])
    return found.select("total_acc", F.col("q0").alias("median"))


@query("group_median_approx")
def group_median_approx(spark, sf_dir):
    rows = loans(spark, sf_dir, ["total_acc", "mort_acc"])
    found = approx_quantiles(rows, ["mort_acc"], [0.5], ["total_acc"])
    return found.select("total_acc", F.col("q0").alias("median"))


_MEDIANS = ["mort_acc", "revol_util", "pub_rec_bankruptcies"]


@query(
    "global_medians",
    f"WITH long AS ({_long(_MEDIANS)}) SELECT \"column\", median(value) AS median FROM long GROUP BY \"column\"",
)
def global_medians(spark, sf_dir):
    found = exact_quantiles(loans(spark, sf_dir, _MEDIANS), _MEDIANS, [0.5])
    return found.select("column", F.col("q0").alias("median"))


@query(
    "income_quantiles",
    "SELECT 'annual_inc' AS \"column\", round(quantile_cont(annual_inc, 0.25), 6) AS q25, "
    "round(quantile_cont(annual_inc, 0.75), 6) AS q75, round(quantile_cont(annual_inc, 0.99), 6) AS q99 FROM loans",
)
def income_quantiles(spark, sf_dir):
    found = exact_quantiles(loans(spark, sf_dir, ["annual_inc"]), ["annual_inc"], [0.25, 0.75, 0.99])
    named = found.select("column", F.col("q0").alias("q25"), F.col("q1").alias("q75"), F.col("q2").alias("q99"))
    return _rounded(named, ["q25", "q75", "q99"])


_NULLS = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS null_count, count(*) AS n FROM loans" for c in RAW_COLUMNS
)


@query(
    "null_percentage",
    f"WITH c AS ({_NULLS}) SELECT \"column\", round(null_count * 1e2 / n, 6) AS null_percentage FROM c WHERE null_count > 0",
)
def null_percentage(spark, sf_dir):
    return _rounded(profile.null_percentage(loans(spark, sf_dir)), ["null_percentage"])


@query(
    "null_report",
    f"WITH c AS ({_NULLS}) SELECT \"column\", null_count, round(null_count * 1e2 / n, 2) AS null_percentage, "
    "n - null_count AS non_null_count FROM c",
)
def null_report(spark, sf_dir):
    return profile.null_report(loans(spark, sf_dir))


_COUNTED = ["loan_status", "grade", "term", "home_ownership", "verification_status", "purpose", "emp_length"]


@query(
    "value_counts",
    f"WITH long AS ({_long(_COUNTED)}) SELECT \"column\", value, count(*) AS n, "
    "round(CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER (PARTITION BY \"column\") AS DOUBLE), 9) AS share "
    "FROM long GROUP BY \"column\", value",
)
def value_counts(spark, sf_dir):
    return _rounded(profile.value_counts(loans(spark, sf_dir, _COUNTED), _COUNTED), ["share"], 9)


@query(
    "etl_target_stats",
    "SELECT loan_status, count(*) AS n, round(count(*) * 1e2 / CAST(sum(count(*)) OVER () AS DOUBLE), 6) AS percent "
    "FROM etl GROUP BY loan_status",
    (*ETL_PARTS, "etl"),
)
def etl_target_stats(spark, sf_dir):
    return _rounded(profile.target_mix(etl_loans(spark, sf_dir), "loan_status"), ["percent"])


@query(
    "distinct_counts",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct FROM loans" for c in RAW_COLUMNS
    ),
)
def distinct_counts(spark, sf_dir):
    return profile.distinct_counts(loans(spark, sf_dir))


@query("distinct_counts_approx")
def distinct_counts_approx(spark, sf_dir):
    return profile.distinct_counts(loans(spark, sf_dir), approximate=True)


_UNKEYED = [c for c in RAW_COLUMNS if c != "loan_id"]
# Loans of which every seventh comes twice, the second time under a new key.
_REPEATED_SQL = "(SELECT * FROM loans UNION ALL SELECT * REPLACE (loan_id + 10000000 AS loan_id) FROM loans WHERE loan_id % 7 = 0)"


def _repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = loans(spark, sf_dir)
    again = rows.filter("loan_id % 7 = 0").withColumn("loan_id", F.col("loan_id") + 10000000)
    return rows.unionByName(again)


@query(
    "duplicate_rows",
    f"SELECT CAST(sum(n) AS BIGINT) AS rows, CAST(sum(n - 1) AS BIGINT) AS duplicate_rows, "
    "round(CAST(sum(n - 1) AS DOUBLE) * 1e2 / CAST(sum(n) AS DOUBLE), 6) AS percent "
    f"FROM (SELECT count(*) AS n FROM {_REPEATED_SQL} l "
    f"GROUP BY {', '.join(_UNKEYED)}) g",
)
def duplicate_rows(spark, sf_dir):
    return _rounded(profile.duplicate_rows(_repeated(spark, sf_dir).drop("loan_id")), ["percent"])


@query(
    "summary_numeric",
    f"WITH long AS ({_long(_RAW_NUMBERS)}) SELECT \"column\", count(value) AS count, round(avg(value), 4) AS mean, "
    "round(stddev_samp(value), 4) AS std, min(value) AS min, round(quantile_cont(value, 0.25), 6) AS q25, "
    "round(quantile_cont(value, 0.5), 6) AS q50, round(quantile_cont(value, 0.75), 6) AS q75, max(value) AS max "
    "FROM long GROUP BY \"column\"",
)
def summary_numeric(spark, sf_dir):
    found = profile.summary_numeric(loans(spark, sf_dir, _RAW_NUMBERS), _RAW_NUMBERS)
    return _rounded(_rounded(found, ["mean", "std"], 4), ["q25", "q50", "q75"])


@query(
    "summary_categorical",
    f"WITH long AS ({_long(_RAW_TEXTS)}), c AS (SELECT \"column\", value, count(*) AS n FROM long GROUP BY ALL), "
    "r AS (SELECT *, row_number() OVER (PARTITION BY \"column\" ORDER BY n DESC, value) AS k FROM c) "
    "SELECT \"column\", CAST(sum(n) AS BIGINT) AS count, count(*) AS \"unique\", "
    "max(value) FILTER (WHERE k = 1) AS top, max(n) AS freq FROM r GROUP BY \"column\"",
)
def summary_categorical(spark, sf_dir):
    return profile.summary_categorical(loans(spark, sf_dir, _RAW_TEXTS), _RAW_TEXTS)


@query("table_summary")
def table_summary(spark, sf_dir):
    return profile.summary(loans(spark, sf_dir))


_ETL_STATS = ["int_rate", "annual_inc", "dti", "revol_util"]


@query(
    "etl_numeric_stats",
    f"WITH long AS ({_long(_ETL_STATS, 'etl')}) SELECT \"column\", round(avg(value), 4) AS mean, "
    "round(stddev_samp(value), 4) AS std, min(value) AS min, max(value) AS max FROM long GROUP BY \"column\"",
    (*ETL_PARTS, "etl"),
)
def etl_numeric_stats(spark, sf_dir):
    return _rounded(profile.numeric_stats(etl_loans(spark, sf_dir), _ETL_STATS), ["mean", "std"], 4)


@query(
    "skew_loan_to_income",
    "SELECT round(skewness(loan_amnt / annual_inc), 6) AS skewness FROM loans WHERE annual_inc > 0",
)
def skew_loan_to_income(spark, sf_dir):
    rows = loans(spark, sf_dir, ["loan_amnt", "annual_inc"]).filter("annual_inc > 0")
    ratio = rows.select((F.col("loan_amnt") / F.col("annual_inc")).alias("r"))
    return ratio.agg(F.round(profile.corrected_skewness("r"), 6).alias("skewness"))


_CODED = [*CATEGORICAL, "loan_status"]
_MATRIX = [*NUMERIC, *_CODED]
_CODES_SQL = (
    "SELECT "
    + ", ".join(NUMERIC)
    + ", "
    + ", ".join(f"CAST(dense_rank() OVER (ORDER BY {c}) - 1 AS DOUBLE) AS {c}" for c in _CODED)
    + " FROM prepared"
)


@query(
    "correlation_matrix",
    f"WITH coded AS ({_CODES_SQL}) "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, "
        + ("1e0" if a == b else f"round(corr({a}, {b}), 6)")
        + " AS correlation"
        + ("" if a == b else " FROM coded")
        for a in _MATRIX
        for b in _MATRIX
    ),
    PREPARED_PARTS,
)
def correlation_matrix(spark, sf_dir):
    rows = stored(spark, sf_dir)
    labels = encode.fitted_labels(encode.vocabulary(rows, _CODED))
    coded = encode.label_encode(rows, labels, _CODED, suffix="__code")
    coded = coded.select(*NUMERIC, *[F.col(f"{c}__code").alias(c) for c in _CODED])
    return _rounded(profile.correlation_matrix(coded, _MATRIX), ["correlation"])


_GAPPED = ["mort_acc", "revol_util", "pub_rec_bankruptcies", "dti", "annual_inc"]


@query(
    "correlation_matrix_gaps",
    " UNION ALL ".join(
        f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, "
        f"round(corr({a}, {b}), 6) AS correlation FROM loans"
        for a, b in permutations(_GAPPED, 2)
    )
    + "".join(f" UNION ALL SELECT '{c}', '{c}', 1e0" for c in _GAPPED),
)
def correlation_matrix_gaps(spark, sf_dir):
    """Columns with missing values: every pair over the rows that have both."""
    return _rounded(profile.correlation_matrix(loans(spark, sf_dir, _GAPPED), _GAPPED), ["correlation"])


@query(
    "correlated_pairs",
    "WITH c AS ("
    + " UNION ALL ".join(
        f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, round(abs(corr({a}, {b})), 6) AS correlation FROM loans"
        for a, b in combinations(_RAW_NUMBERS, 2)
    )
    + ") SELECT * FROM c WHERE correlation >= 5e-1",
)
def correlated_pairs(spark, sf_dir):
    rows = loans(spark, sf_dir, _RAW_NUMBERS)
    return _rounded(profile.correlated_pairs(rows, _RAW_NUMBERS, 0.5), ["correlation"])


_LABEL_SQL = "CASE loan_status WHEN 'Fully Paid' THEN 1e0 WHEN 'Charged Off' THEN 0e0 END"


@query(
    "target_correlation",
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(abs(corr({c}, {_LABEL_SQL})), 6) AS importance FROM prepared" for c in NUMERIC
    ),
    PREPARED_PARTS,
)
def target_correlation(spark, sf_dir):
    rows = stored(spark, sf_dir).withColumn(
        "label", cleaning.target_code(F.col("loan_status")).cast("double")
    )
    return _rounded(profile.target_correlation(rows, NUMERIC, "label"), ["importance"])


@query("zero_income_count", "SELECT count(*) FILTER (WHERE annual_inc = 0) AS zero_income, "
       "count(*) FILTER (WHERE annual_inc <= 0) AS not_positive FROM loans")
def zero_income_count(spark, sf_dir):
    return loans(spark, sf_dir, ["annual_inc"]).agg(
        F.count_if(F.col("annual_inc") == 0).alias("zero_income"),
        F.count_if(F.col("annual_inc") <= 0).alias("not_positive"),
    )


def _box_sql(by: str, columns: list[str], source: str) -> str:
    return (
        f"WITH long AS ({_long(columns, source, by)}), q AS (SELECT {by}, \"column\", count(*) AS n, "
        "quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3 "
        f"FROM long GROUP BY {by}, \"column\") "
        f"SELECT q.{by}, q.\"column\", q.n, round(any_value(q.q1), 6) AS q1, round(any_value(q.median), 6) AS median, "
        "round(any_value(q.q3), 6) AS q3, min(value) FILTER (WHERE value >= q1 - (q3 - q1) * 1.5e0) AS low_whisker, "
        "max(value) FILTER (WHERE value <= q3 + (q3 - q1) * 1.5e0) AS high_whisker "
        f"FROM long JOIN q ON long.{by} = q.{by} AND long.\"column\" = q.\"column\" "
        f"GROUP BY q.{by}, q.\"column\", q.n"
    )


_BOXED = ["loan_amnt", "int_rate", "installment", "annual_inc", "dti", "open_acc", "total_acc", "revol_bal", "revol_util"]
_BOXED_DERIVED = ["loan_to_income", "total_interest_owed", "installment_to_income_ratio", "active_credit_pct", "credit_age"]


@query("box_stats", _box_sql("loan_status", _BOXED, "loans"))
def box_stats(spark, sf_dir):
    found = profile.box_stats(loans(spark, sf_dir, ["loan_status", *_BOXED]), _BOXED, "loan_status")
    return _rounded(found, ["q1", "median", "q3"])


@query("box_stats_derived", _box_sql("loan_status", _BOXED_DERIVED, "prepared"), PREPARED_PARTS)
def box_stats_derived(spark, sf_dir):
    found = profile.box_stats(stored(spark, sf_dir), _BOXED_DERIVED, "loan_status")
    return _rounded(found, ["q1", "median", "q3"])


_MISSING_BOXED = ["annual_inc", "dti", "loan_amnt", "total_acc"]


@query(
    "missingness_box",
    _box_sql(
        "mort_acc_missing",
        _MISSING_BOXED,
        "(SELECT CAST(mort_acc IS NULL AS INTEGER) AS mort_acc_missing, "
        + ", ".join(_MISSING_BOXED)
        + " FROM loans) f",
    ),
)
def missingness_box(spark, sf_dir):
    rows = loans(spark, sf_dir, ["mort_acc", *_MISSING_BOXED]).withColumn(
        "mort_acc_missing", F.col("mort_acc").isNull().cast("int")
    )
    found = profile.box_stats(rows, _MISSING_BOXED, "mort_acc_missing")
    return _rounded(found, ["q1", "median", "q3"])


_BINS = {"annual_inc": 50, "loan_amnt": 30, "int_rate": 30, "dti": 50, "open_acc": 20, "total_acc": 30, "revol_util": 20}


@query(
    "histogram",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", bin, round(lo + w * bin, 6) AS low, round(lo + w * (bin + 1), 6) AS high, "
        f"count(*) AS n FROM (SELECT lo, w, CAST(least(floor(({c} - lo) / w), {n - 1}) AS INTEGER) AS bin "
        f"FROM loans, (SELECT min({c}) AS lo, (max({c}) - min({c})) / {n} AS w FROM loans) m "
        f"WHERE {c} IS NOT NULL) b GROUP BY lo, w, bin"
        for c, n in _BINS.items()
    ),
)
def histogram(spark, sf_dir):
    return _rounded(profile.histogram(loans(spark, sf_dir, list(_BINS)), _BINS), ["low", "high"])


@query(
    "null_patterns",
    "SELECT concat("
    + ", ".join(f"CAST(CAST({c} IS NULL AS INTEGER) AS VARCHAR)" for c in RAW_COLUMNS)
    + ") AS pattern, "
    + " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in RAW_COLUMNS)
    + " AS missing, count(*) AS n FROM loans GROUP BY ALL",
)
def null_patterns(spark, sf_dir):
    return profile.null_patterns(loans(spark, sf_dir), RAW_COLUMNS)


@query(
    "credit_line_years",
    "SELECT CAST(year(try_strptime(earliest_cr_line, '%b-%Y')) AS INTEGER) AS year, count(*) AS n FROM loans GROUP BY ALL",
)
def credit_line_years(spark, sf_dir):
    return profile.credit_line_years(loans(spark, sf_dir, ["earliest_cr_line"]))


@query("table_fingerprint")
def table_fingerprint(spark, sf_dir):
    return fingerprint(loans(spark, sf_dir))


_SKETCHED_NUMBERS, _SKETCHED_TEXTS = ["annual_inc", "dti", "revol_util", "mort_acc"], ["purpose", "earliest_cr_line"]
_SKETCH_PROBABILITIES = [0.01, 0.25, 0.5, 0.75, 0.99]


@query(
    "sketch_merge",
    " UNION ALL ".join(
        f"SELECT grade, '{c}' AS \"column\", count(*) AS \"rows\", count({c}) AS filled, TRUE AS quantiles_within, "
        "TRUE AS distinct_within FROM loans GROUP BY grade"
        for c in [*_SKETCHED_NUMBERS, *_SKETCHED_TEXTS]
    ),
)
def sketch_merge(spark, sf_dir):
    """Sketches per month and grade, stored, merged without the rows, and held against the rows.

    Within: every quantile splits the values at its probability up to 1 %, the distinct count is
    off by 6.5 % at most (four standard errors).
    """
    columns = [*_SKETCHED_NUMBERS, *_SKETCHED_TEXTS]
    rows = loans(spark, sf_dir, ["issue_d", "grade", *columns])
    path = work_path(spark, "sketches")
    by_month = sketches.sketched(rows, F.trunc("issue_d", "month"), _SKETCHED_NUMBERS, _SKETCHED_TEXTS, ["grade"])
    sketches.store(by_month, path)
    merged = sketches.merged(sketches.stored(spark, path), ["grade"])
    found = materialise(sketches.estimates(merged, _SKETCH_PROBABILITIES), "estimates")

    long = rows.select(
        "grade",
        F.explode(
            F.array(
                *[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x"), F.col(c).cast("string").alias("t")) for c in _SKETCHED_NUMBERS],
                *[F.struct(F.lit(c).alias("column"), F.lit(None).cast("double").alias("x"), F.col(c).alias("t")) for c in _SKETCHED_TEXTS],
            )
        ).alias("v"),
    ).select("grade", "v.*")
    # Rows of the sketch table: grades times columns.
    known = local_copy(found.select("grade", "column", "values"))
    ranked = long.groupBy("grade", "column", "x", "t").agg(F.count(F.lit(1)).alias("n")).join(
        F.broadcast(known) if known is not None else found.select("grade", "column", "values"), ["grade", "column"]
    )
    below, upto = [], []
    for i in range(len(_SKETCH_PROBABILITIES)):
        below.append(F.coalesce(F.sum(F.when(F.col("x") < F.col("values")[i], F.col("n"))), F.lit(0)))
        upto.append(F.coalesce(F.sum(F.when(F.col("x") <= F.col("values")[i], F.col("n"))), F.lit(0)))
    exact = ranked.groupBy("grade", "column").agg(
        F.count("t").alias("_distinct"), F.array(*below).alias("_below"), F.array(*upto).alias("_upto")
    )
    joined = found.join(exact, ["grade", "column"])
    fits = [
        (F.col("_below")[i] <= (p + 0.01) * F.col("filled")) & (F.col("_upto")[i] >= (p - 0.01) * F.col("filled"))
        for i, p in enumerate(_SKETCH_PROBABILITIES)
    ]
    held = F.forall(F.array(*fits), lambda fit: fit)
    distinct = F.abs(F.col("n_distinct") - F.col("_distinct")) <= 0.065 * F.col("_distinct")
    return joined.select(
        "grade",
        "column",
        "rows",
        "filled",
        (F.col("values").isNull() | held).alias("quantiles_within"),
        distinct.alias("distinct_within"),
    )


# Validation

_REQUIRED = list(LOAN_RULES.required)
_EXTRA = [c for c in RAW_COLUMNS if c not in _REQUIRED]
_SCHEMA_SQL = " UNION ALL ".join(
    f"SELECT 'schema_extra' AS \"check\", '{c}' AS \"column\", 'warning' AS severity, "
    f"CAST(count({c}) AS DOUBLE) AS observed, CAST(NULL AS DOUBLE) AS \"limit\" FROM loans"
    for c in _EXTRA
)
_NULL_LIMIT = (
    "CASE \"column\" "
    + " ".join(f"WHEN '{c}' THEN {v!r}e0" for c, v in LOAN_RULES.null_limits.items())
    + f" ELSE {LOAN_RULES.default_null_limit!r}e0 END"
)
_NULLS_SQL = (
    f"SELECT 'nulls' AS \"check\", \"column\", CASE WHEN observed > \"limit\" THEN 'error' ELSE 'warning' END AS severity, "
    f"round(observed, 6) AS observed, \"limit\" FROM (SELECT \"column\", null_count * 1e2 / n AS observed, "
    f"{_NULL_LIMIT} AS \"limit\" FROM ({_NULLS}) c) d WHERE observed > \"limit\" * 8e-1"
)
_RANGES_SQL = " UNION ALL ".join(
    f"SELECT * FROM (SELECT 'ranges' AS \"check\", '{c}' AS \"column\", '{severity}' AS severity, "
    f"CAST(count(*) AS DOUBLE) AS observed, {bound!r}e0 AS \"limit\" FROM loans WHERE {c} {op} {bound!r}e0) r "
    "WHERE observed > 0"
    for c, (low, high) in LOAN_RULES.ranges.items()
    for bound, op, severity in ((low, "<", "error"), (high, ">", "warning"))
)
_OFFENDERS_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {c} AS value, count(*) AS n FROM loans WHERE {c} NOT IN ("
    + ", ".join(f"'{v}'" for v in values)
    + f") GROUP BY {c}"
    for c, values in LOAN_RULES.allowed.items()
)
_CATEGORIES_SQL = (
    "SELECT 'categories' AS \"check\", \"column\", 'warning' AS severity, CAST(count(*) AS DOUBLE) AS observed, "
    f"0e0 AS \"limit\" FROM ({_OFFENDERS_SQL}) o GROUP BY \"column\""
)


def _duplicates_sql(source: str = "loans") -> str:
    return (
        "SELECT * FROM (SELECT 'duplicates' AS \"check\", CAST(NULL AS VARCHAR) AS \"column\", 'warning' AS severity, "
        "round(CAST(sum(n - 1) AS DOUBLE) * 1e2 / CAST(sum(n) AS DOUBLE), 6) AS observed, 5e0 AS \"limit\" FROM "
        f"(SELECT count(*) AS n FROM {source} l GROUP BY {', '.join(_UNKEYED)}) g) d WHERE observed > \"limit\""
    )


_IMBALANCE_SQL = (
    "SELECT * FROM (SELECT 'imbalance' AS \"check\", 'loan_status' AS \"column\", 'warning' AS severity, "
    "round(min(share), 6) AS observed, 5e0 AS \"limit\" FROM (SELECT count(*) * 1e2 / "
    "CAST(sum(count(*)) OVER () AS DOUBLE) AS share FROM loans GROUP BY loan_status) s) i WHERE observed < \"limit\""
)


@query("check_schema", _SCHEMA_SQL)
def check_schema(spark, sf_dir):
    return quality.check_schema(loans(spark, sf_dir))


@query("check_nulls", _NULLS_SQL)
def check_nulls(spark, sf_dir):
    return _rounded(quality.check_nulls(loans(spark, sf_dir)), ["observed"])


@query("check_ranges", _RANGES_SQL)
def check_ranges(spark, sf_dir):
    return quality.check_ranges(loans(spark, sf_dir))


@query("unexpected_values", _OFFENDERS_SQL)
def unexpected_values(spark, sf_dir):
    return quality.unexpected_values(loans(spark, sf_dir))


@query("check_categories", _CATEGORIES_SQL)
def check_categories(spark, sf_dir):
    return quality.check_categories(loans(spark, sf_dir))


@query("check_duplicates", _duplicates_sql(_REPEATED_SQL))
def check_duplicates(spark, sf_dir):
    return _rounded(quality.check_duplicates(_repeated(spark, sf_dir)), ["observed"])


@query("check_imbalance", _IMBALANCE_SQL)
def check_imbalance(spark, sf_dir):
    return _rounded(quality.check_imbalance(loans(spark, sf_dir, ["loan_status"])), ["observed"])


_ISSUES_SQL = " UNION ALL ".join(
    [_SCHEMA_SQL, _NULLS_SQL, _RANGES_SQL, _CATEGORIES_SQL, _duplicates_sql(), _IMBALANCE_SQL]
)


@query("validation_issues", _ISSUES_SQL)
def validation_issues(spark, sf_dir):
    return _rounded(quality.issues(loans(spark, sf_dir)), ["observed"])


@query(
    "validation_report",
    f"WITH i AS ({_ISSUES_SQL}) SELECT count(*) FILTER (WHERE severity = 'error') = 0 AS is_valid, "
    "count(*) FILTER (WHERE severity = 'error') AS errors, count(*) FILTER (WHERE severity = 'warning') AS warnings FROM i",
)
def validation_report(spark, sf_dir):
    return quality.validate(loans(spark, sf_dir))[1]


_CHECKED_SQL = (
    f"SELECT \"check\", \"column\", severity, observed, \"limit\", CAST(NULL AS VARCHAR) AS value FROM ({_ISSUES_SQL}) i "
    f"UNION ALL SELECT 'category_value', \"column\", 'warning', CAST(n AS DOUBLE), 0e0, value FROM ({_OFFENDERS_SQL}) o"
)


@query("checked_write", _CHECKED_SQL)
def checked_write(spark, sf_dir):
    """Issues found by the pass that writes the loans, and a row per value outside an allowed set."""
    done = quality.write_checked(loans(spark, sf_dir), work_path(spark, "checked"))
    listed = done.offenders.select(
        F.lit("category_value").alias("check"),
        "column",
        F.lit("warning").alias("severity"),
        F.col("n").cast("double").alias("observed"),
        F.lit(0.0).alias("limit"),
        "value",
    )
    found = done.issues.withColumn("value", F.lit(None).cast("string"))
    return _rounded(found.unionByName(listed), ["observed"])


# Selection and drift


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir).withColumn("label", cleaning.target_code(F.col("loan_status")))


def _information_sql(cells: str) -> str:
    return (
        f"WITH cells AS ({cells}), c AS (SELECT feature, bin, label, CAST(count(*) AS DOUBLE) AS n FROM cells GROUP BY ALL), "
        "t AS (SELECT *, CAST(sum(n) OVER (PARTITION BY feature) AS DOUBLE) AS t, "
        "CAST(sum(n) OVER (PARTITION BY feature, bin) AS DOUBLE) AS b, "
        "CAST(sum(n) OVER (PARTITION BY feature, label) AS DOUBLE) AS l FROM c) "
        "SELECT feature, round(sum((n / t) * ln((n * t) / (b * l))), 9) AS importance FROM t GROUP BY feature"
    )


_TEXT_CELLS = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {c} AS bin, {_LABEL_SQL} AS label FROM prepared WHERE loan_status <> 'Current'"
    for c in CATEGORICAL
)
_NUMBER_CELLS = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST(len(list_filter((SELECT quantile_cont({c}, [0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9]) "
    f"FROM prepared WHERE loan_status <> 'Current'), lambda x: x < {c})) AS VARCHAR) AS bin, {_LABEL_SQL} AS label "
    "FROM prepared WHERE loan_status <> 'Current'"
    for c in NUMERIC
)


@query("mutual_information", _information_sql(_TEXT_CELLS), PREPARED_PARTS)
def mutual_information(spark, sf_dir):
    found = features.mutual_information(_labelled(spark, sf_dir), "label", texts=CATEGORICAL)
    return _rounded(found, ["importance"], 9)


@query("mutual_information_numeric", _information_sql(_NUMBER_CELLS), PREPARED_PARTS)
def mutual_information_numeric(spark, sf_dir):
    found = features.mutual_information(_labelled(spark, sf_dir), "label", numbers=NUMERIC)
    return _rounded(found, ["importance"], 9)


def _digamma_sql(x: str) -> str:
    y = f"({x} + 1e1)"
    shifted = " - ".join(f"1e0 / ({x} + {i}e0)" for i in range(10))
    return (
        f"(ln({y}) - 5e-1 / {y} - 1e0 / 12 / pow({y}, 2) + 1e0 / 120 / pow({y}, 4) - 1e0 / 252 / pow({y}, 6) "
        f"+ 1e0 / 240 / pow({y}, 8) - {shifted})"
    )


_CLOSEST = 3
_AHEAD = [f"lead(value, {i}) OVER w" for i in range(1, _CLOSEST + 1)]
_BEHIND = [f"lag(value, {i}) OVER w" for i in range(1, _CLOSEST + 1)]
_SPANS = ", ".join(
    f"greatest(coalesce(value - b{i}, {'0' if i == 0 else 'NULL'}), coalesce(a{_CLOSEST - i} - value, "
    f"{'0' if i == _CLOSEST else 'NULL'}), CASE WHEN b{i} IS NULL OR a{_CLOSEST - i} IS NULL THEN 'infinity'::DOUBLE END)"
    for i in range(_CLOSEST + 1)
)
# Every row apart: the k-th neighbour is the nearest end of the k + 1 windows of k rows around it.
_NEIGHBOUR_SQL = (
    "WITH points AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {_LABEL_SQL} AS label, coalesce({c}, 0) AS value FROM prepared WHERE loan_status <> 'Current'"
        for c in NUMERIC
    )
    + "), around AS (SELECT *, value AS a0, value AS b0, "
    + ", ".join(f"{e} AS a{i}" for i, e in enumerate(_AHEAD, 1))
    + ", "
    + ", ".join(f"{e} AS b{i}" for i, e in enumerate(_BEHIND, 1))
    + ", count(*) OVER (PARTITION BY feature, label) AS size FROM points WINDOW w AS (PARTITION BY feature, label ORDER BY value)), "
    f"far AS (SELECT *, least({_SPANS}) AS d FROM around), "
    "ends AS (SELECT feature, label, value, size, d, "
    + "coalesce(greatest("
    + ", ".join(f"CASE WHEN d > 0 AND value - b{i} = d THEN b{i} END" for i in range(1, _CLOSEST + 1))
    + "), value - d) AS low, coalesce(least("
    + ", ".join(f"CASE WHEN d > 0 AND a{i} - value = d THEN a{i} END" for i in range(1, _CLOSEST + 1))
    + "), value + d) AS high FROM far), "
    "sums AS (SELECT feature, value, n, sum(n) OVER (PARTITION BY feature ORDER BY value) AS upto "
    "FROM (SELECT feature, value, count(*) AS n FROM points GROUP BY ALL)), "
    "twins AS (SELECT feature, label, value, count(*) AS own FROM points GROUP BY ALL), "
    "counted AS (SELECT e.feature, e.size, CAST(CASE WHEN d = 0 THEN s.n ELSE h.upto - coalesce(l.upto, 0) END AS DOUBLE) AS m, "
    f"CAST(CASE WHEN d = 0 THEN t.own ELSE {_CLOSEST} END AS DOUBLE) AS k "
    "FROM ends e JOIN sums s USING (feature, value) JOIN twins t USING (feature, label, value) "
    "ASOF LEFT JOIN sums h ON e.feature = h.feature AND e.high > h.value "
    "ASOF LEFT JOIN sums l ON e.feature = l.feature AND e.low >= l.value) "
    f"SELECT feature, round(greatest(0, {_digamma_sql('CAST(count(*) AS DOUBLE)')} + avg({_digamma_sql('k')} - {_digamma_sql('m')} "
    f"- {_digamma_sql('CAST(size AS DOUBLE)')})), 8) AS importance FROM counted GROUP BY feature"
)


@query("neighbour_information", _NEIGHBOUR_SQL, PREPARED_PARTS)
def neighbour_information(spark, sf_dir):
    """Information by the third neighbour of the same class, over all labelled loans."""
    found = neighbours.neighbour_information(_labelled(spark, sf_dir), "label", NUMERIC, _CLOSEST)
    return _rounded(found, ["importance"], 8)


@query(
    "select_top_features",
    _information_sql(f"{_TEXT_CELLS} UNION ALL {_NUMBER_CELLS}").replace(
        "SELECT feature, round(sum(", "SELECT feature, (SELECT count(*) FROM prepared) AS non_null, round(sum("
    )
    + " ORDER BY importance DESC, feature LIMIT 3",
    PREPARED_PARTS,
)
def select_top_features(spark, sf_dir):
    """The three most informative columns, with their strength and the values the projection holds."""
    rows = _labelled(spark, sf_dir)
    best = features.strongest_features(rows, "label", [*CATEGORICAL, *NUMERIC], 3)
    chosen = rows.select("loan_id", *[f for f, _ in best])
    held = profile.per_column(chosen, [f for f, _ in best], {"non_null": F.count}).withColumnRenamed("column", "feature")
    strength = spark.createDataFrame(best, "feature string, importance double")
    return _rounded(held.join(F.broadcast(strength), "feature"), ["importance"], 9)



_DRIFT_TEXT = ["grade", "home_ownership", "purpose", "emp_length"]
_DRIFT_NUMBERS = ["int_rate", "dti", "annual_inc", "revol_util"]
_OLD, _NEW = "year(issue_d) < 1998", "year(issue_d) >= 1998"


def _drift_cells(where: str, name: str) -> str:
    texts = [
        f"SELECT '{c}' AS feature, coalesce({c}, '(missing)') AS bin FROM loans WHERE {where}" for c in _DRIFT_TEXT
    ]
    numbers = [
        f"SELECT '{c}' AS feature, coalesce(CAST(len(list_filter((SELECT quantile_cont({c}, "
        f"[0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9]) FROM loans WHERE {_OLD}), lambda x: x < {c})) AS VARCHAR), '(missing)') "
        f"AS bin FROM loans WHERE {where} AND {c} IS NOT NULL UNION ALL "
        f"SELECT '{c}', '(missing)' FROM loans WHERE {where} AND {c} IS NULL"
        for c in _DRIFT_NUMBERS
    ]
    inner = " UNION ALL ".join([*texts, *numbers])
    return f"SELECT feature, bin, count(*) AS {name} FROM ({inner}) x GROUP BY feature, bin"


@query(
    "drift_psi",
    f"WITH e AS ({_drift_cells(_OLD, 'e')}), a AS ({_drift_cells(_NEW, 'a')}), "
    "j AS (SELECT feature, bin, CAST(coalesce(e, 0) AS DOUBLE) AS e, CAST(coalesce(a, 0) AS DOUBLE) AS a "
    "FROM e FULL JOIN a USING (feature, bin)), "
    "s AS (SELECT feature, greatest(e / CAST(sum(e) OVER (PARTITION BY feature) AS DOUBLE), 1e-6) AS p, "
    "greatest(a / CAST(sum(a) OVER (PARTITION BY feature) AS DOUBLE), 1e-6) AS q FROM j) "
    "SELECT feature, round(sum((q - p) * ln(q / p)), 9) AS psi, sum((q - p) * ln(q / p)) > 1e-1 AS alert "
    "FROM s GROUP BY feature",
)
def drift_psi(spark, sf_dir):
    rows = loans(spark, sf_dir, ["issue_d", *_DRIFT_TEXT, *_DRIFT_NUMBERS])
    found = drift.stability_index(
        rows.filter(F.year("issue_d") < 1998), rows.filter(F.year("issue_d") >= 1998), _DRIFT_TEXT, _DRIFT_NUMBERS
    )
    return _rounded(found, ["psi"], 9)
