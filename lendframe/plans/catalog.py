"""Registration of queries and of the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lendframe.plans.loans import loans_sql
from lendframe.session import tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

AS_OF_YEAR = 2025
_HASH = "CAST(concat('0x', substr(md5(concat(CAST(loan_id AS VARCHAR), ':42')), 1, 8)) AS BIGINT)"
HASH_SQL = _HASH
EMP_TEXT_SQL = (
    "CASE WHEN trim(emp_length) = '10+ years' THEN '10' WHEN trim(emp_length) = '< 1 year' THEN '0' "
    "ELSE coalesce(CAST(TRY_CAST(split_part(trim(emp_length), ' ', 1) AS BIGINT) AS VARCHAR), 'Unknown') END"
)
EMP_NUMBER_SQL = (
    "CASE WHEN emp_length = '10+ years' THEN 10 WHEN emp_length = '< 1 year' THEN 0 "
    "WHEN emp_length = 'Unknown' THEN -1 ELSE TRY_CAST(regexp_extract(emp_length, '(\\d+)', 1) AS INTEGER) END"
)
LINE_DATE_SQL = (
    "CAST(coalesce(try_strptime(earliest_cr_line, '%b-%Y'), TRY_CAST(earliest_cr_line AS TIMESTAMP)) AS DATE)"
)
RATIO_SQL = {
    "loan_to_income": "loan_amnt / nullif(annual_inc, 0)",
    "total_interest_owed": "loan_amnt * (int_rate / 1e2)",
    "installment_to_income_ratio": "installment / nullif(annual_inc / 12e0, 0)",
    "active_credit_pct": "CASE WHEN total_acc > 0 THEN open_acc / total_acc END",
    "credit_age": f"CAST({AS_OF_YEAR} - year({LINE_DATE_SQL}) AS DOUBLE)",
}


def bin_sql(c: str) -> str:
    return f"CASE WHEN {c} = 0 THEN '0' WHEN {c} = 1 THEN '1' ELSE '2+' END"


_RATIOS = ", ".join(f"{sql} AS {name}" for name, sql in RATIO_SQL.items())
_PREPARED = (
    "loan_id, term, int_rate, grade, emp_length, home_ownership, annual_inc, verification_status, purpose, "
    "dti, pub_rec, revol_util, initial_list_status, mort_acc, pub_rec_bankruptcies, loan_to_income, "
    "total_interest_owed, installment_to_income_ratio, active_credit_pct, credit_age, loan_status"
)
_NO_NULL = " AND ".join(f"{c.strip()} IS NOT NULL" for c in _PREPARED.split(",")[1:])

# Named parts a checking query may read; a query lists the ones it uses.
PARTS = {
    "loans": loans_sql(),
    "medians": (
        "SELECT median(mort_acc) AS mort, median(revol_util) AS util, median(pub_rec_bankruptcies) AS bank "
        "FROM loans"
    ),
    "group_medians": (
        "SELECT total_acc, median(mort_acc) AS m FROM loans WHERE total_acc IS NOT NULL GROUP BY total_acc"
    ),
    "filled": (
        "SELECT loans.* REPLACE (CASE WHEN mort_acc IS NOT NULL THEN mort_acc "
        "WHEN g.total_acc IS NOT NULL THEN g.m ELSE medians.mort END AS mort_acc, "
        "coalesce(revol_util, medians.util) AS revol_util, "
        "coalesce(pub_rec_bankruptcies, medians.bank) AS pub_rec_bankruptcies) "
        "FROM loans LEFT JOIN group_medians g ON loans.total_acc = g.total_acc CROSS JOIN medians"
    ),
    "derived": (
        f"SELECT filled.* REPLACE ({EMP_TEXT_SQL} AS emp_length, {bin_sql('pub_rec')} AS pub_rec, "
        f"{bin_sql('coalesce(pub_rec_bankruptcies, 0)')} AS pub_rec_bankruptcies), {_RATIOS} FROM filled"
    ),
    "prepared": (
        f"SELECT {_PREPARED} FROM derived WHERE annual_inc > 0 AND {_NO_NULL} "
        "AND loan_amnt IS NOT NULL AND installment IS NOT NULL AND open_acc IS NOT NULL AND total_acc IS NOT NULL"
    ),
    "etl_rows": "SELECT * FROM loans WHERE loan_status IN ('Fully Paid', 'Charged Off') AND annual_inc > 0",
    "etl_medians": (
        "SELECT quantile_disc(revol_util, 0.5) AS util, quantile_disc(pub_rec_bankruptcies, 0.5) AS bank "
        "FROM etl_rows"
    ),
    "etl_groups": (
        "SELECT total_acc, quantile_disc(mort_acc, 0.5) AS m FROM etl_rows WHERE total_acc IS NOT NULL "
        "GROUP BY total_acc"
    ),
    "etl_filled": (
        "SELECT etl_rows.* REPLACE (coalesce(mort_acc, g.m) AS mort_acc, "
        "coalesce(revol_util, etl_medians.util) AS revol_util, "
        "coalesce(pub_rec_bankruptcies, etl_medians.bank) AS pub_rec_bankruptcies, "
        "coalesce(emp_length, 'Unknown') AS emp_length) "
        "FROM etl_rows LEFT JOIN etl_groups g ON etl_rows.total_acc = g.total_acc CROSS JOIN etl_medians"
    ),
    "etl": (
        f"SELECT {_PREPARED} FROM (SELECT etl_filled.* REPLACE ({EMP_NUMBER_SQL} AS emp_length, "
        f"{bin_sql('pub_rec')} AS pub_rec, {bin_sql('pub_rec_bankruptcies')} AS pub_rec_bankruptcies), "
        f"{_RATIOS} FROM etl_filled) d WHERE {_NO_NULL}"
    ),
    "scores": (
        f"SELECT loan_id, label, (({_HASH}) % 800 + label * 150 + 25) / 1e3 AS score FROM "
        "(SELECT loan_id, CASE loan_status WHEN 'Fully Paid' THEN 1 WHEN 'Charged Off' THEN 0 END AS label "
        "FROM loans) s WHERE label IS NOT NULL"
    ),
    "hist": (
        "SELECT score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg "
        "FROM scores GROUP BY score"
    ),
    "ranked": (
        "SELECT *, CAST(sum(pos) OVER w AS DOUBLE) AS tp, CAST(sum(neg) OVER w AS DOUBLE) AS fp, "
        "CAST(sum(pos) OVER () AS DOUBLE) AS p_all, CAST(sum(neg) OVER () AS DOUBLE) AS n_all "
        "FROM hist WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING)"
    ),
}


def with_parts(sql: str, *names: str) -> str:
    """`sql` with the named parts, in the given order, as leading common table expressions."""
    head = ", ".join(f"{n} AS ({PARTS[n]})" for n in names)
    if sql.startswith("WITH "):
        return f"WITH {head}, {sql[5:]}"
    return f"WITH {head} {sql}"


LIBRARY = ("loans", "medians", "group_medians", "filled")
PREPARED_PARTS = (*LIBRARY, "derived", "prepared")
ETL_PARTS = ("loans", "etl_rows", "etl_medians", "etl_groups", "etl_filled")
SCORE_PARTS = ("loans", "scores", "hist")


def query(name: str, sql: str | None = None, parts: tuple[str, ...] = ("loans",)):
    """Register a query; `sql` is its checking text over `parts`."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(tune(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_parts(sql, *parts) if parts else sql
        return fn

    return register
