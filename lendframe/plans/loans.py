"""The loan table over the order tables, as one expression per column.

Each expression is plain SQL that Spark and an ANSI engine read the same way, so one text serves
the Spark plan and the checking SQL. Only the joins that the wanted columns need are planned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendframe.schema import RAW_COLUMNS

_DIGIT = "CAST(substr(o_orderpriority, 1, 1) AS DOUBLE)"
_GRADE = "substr('ABCDEFG', CAST(1 + o_orderkey % 7 AS INT), 1)"
_MONTH = "substr('JanFebMarAprMayJunJulAugSepOctNovDec', CAST(month(o_orderdate) AS INT) * 3 - 2, 3)"
_YEAR = "CAST(CAST(year(o_orderdate) AS INT) - CAST(o_custkey % 30 AS INT) AS STRING)"

COLUMN_SQL = {
    "loan_id": "o_orderkey",
    "loan_amnt": "o_totalprice / 1e1",
    "term": "CASE WHEN o_orderkey % 4 = 0 THEN ' 60 months' ELSE ' 36 months' END",
    "int_rate": f"5e0 + 2.5e0 * {_DIGIT} + (o_orderkey % 100) / 5e1",
    "installment": "(o_totalprice / 1e1) / (CASE WHEN o_orderkey % 4 = 0 THEN 6e1 ELSE 3.6e1 END)",
    "grade": _GRADE,
    "sub_grade": f"concat({_GRADE}, CAST(1 + o_orderkey % 5 AS STRING))",
    "emp_title": "CASE o_orderkey % 4 WHEN 0 THEN 'Engineer' WHEN 1 THEN 'Manager' WHEN 2 THEN 'Teacher' END",
    "emp_length": (
        "CASE WHEN o_orderkey % 211 = 0 THEN 'n/a' WHEN o_custkey % 13 = 0 THEN NULL "
        "WHEN o_custkey % 13 = 1 THEN '< 1 year' WHEN o_custkey % 13 = 2 THEN '1 year' "
        "WHEN o_custkey % 13 >= 11 THEN '10+ years' "
        "ELSE concat(CAST(o_custkey % 13 - 1 AS STRING), ' years') END"
    ),
    "home_ownership": (
        "CASE c_mktsegment WHEN 'BUILDING' THEN 'OWN' WHEN 'FURNITURE' THEN 'RENT' "
        "WHEN 'MACHINERY' THEN 'OTHER' ELSE 'MORTGAGE' END"
    ),
    "annual_inc": "c_acctbal * 12e0",
    "verification_status": (
        "CASE o_custkey % 3 WHEN 0 THEN 'Verified' WHEN 1 THEN 'Source Verified' ELSE 'Not Verified' END"
    ),
    "issue_d": "CAST(o_orderdate AS DATE)",
    "loan_status": (
        "CASE WHEN o_orderkey % 97 = 0 THEN 'Current' "
        "WHEN o_orderstatus = 'F' AND o_orderkey % 5 < 3 THEN 'Charged Off' ELSE 'Fully Paid' END"
    ),
    "purpose": (
        "CASE o_orderkey % 3 WHEN 0 THEN 'debt_consolidation' WHEN 1 THEN 'credit_card' "
        "ELSE 'home_improvement' END"
    ),
    "title": "CASE WHEN o_orderkey % 2 = 0 THEN 'Debt consolidation' END",
    "dti": (
        "CASE WHEN o_orderkey % 503 = 0 THEN 1.2e2 "
        "ELSE (o_orderkey * 7 % 400) / 1e1 + (CASE WHEN o_orderstatus = 'F' THEN 6e0 ELSE 0e0 END) END"
    ),
    "earliest_cr_line": (
        "CASE WHEN o_orderkey % 401 = 0 THEN NULL WHEN o_orderkey % 409 = 0 THEN 'xx' "
        f"ELSE concat({_MONTH}, '-', {_YEAR}) END"
    ),
    "open_acc": "CAST(coalesce(n_lines, 0) AS DOUBLE)",
    "pub_rec": "CAST(coalesce(n_ret, 0) AS DOUBLE)",
    "revol_bal": "coalesce(max_price, 0e0)",
    "revol_util": "CASE WHEN o_orderkey % 200 = 0 THEN NULL ELSE (o_custkey * 13 % 1000) / 1e1 END",
    "total_acc": "CAST(coalesce(n_lines, 0) + o_custkey % 20 AS DOUBLE)",
    "initial_list_status": "CASE WHEN o_orderkey % 2 = 0 THEN 'f' ELSE 'w' END",
    "application_type": "CASE WHEN o_orderkey % 20 = 0 THEN 'Joint App' ELSE 'Individual' END",
    "mort_acc": "CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(o_custkey % 5 AS DOUBLE) END",
    "pub_rec_bankruptcies": (
        "CASE WHEN o_orderkey % 150 = 0 THEN NULL WHEN o_orderkey % 20 = 0 THEN 1e0 "
        "WHEN o_orderkey % 77 = 0 THEN 2e0 ELSE 0e0 END"
    ),
    "address": "concat('Street ', CAST(o_custkey % 50 AS STRING))",
}
_CUSTOMER_FIELDS = ("c_mktsegment", "c_acctbal")
_LINE_FIELDS = ("n_lines", "n_ret", "max_price")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def loans(spark: SparkSession, sf_dir: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Loan rows, one per order, holding `columns` (all by default)."""
    wanted = list(columns) if columns is not None else RAW_COLUMNS
    text = " ".join(COLUMN_SQL[c] for c in wanted)
    rows = table(spark, sf_dir, "orders")
    if any(f in text for f in _LINE_FIELDS):
        per_order = (
            table(spark, sf_dir, "lineitem")
            .groupBy("l_orderkey")
            .agg(
                F.count(F.lit(1)).alias("n_lines"),
                F.count_if(F.col("l_returnflag") == "R").alias("n_ret"),
                F.max("l_extendedprice").alias("max_price"),
            )
        )
        rows = rows.join(per_order, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    if any(f in text for f in _CUSTOMER_FIELDS):
        rows = rows.join(
            table(spark, sf_dir, "customer").select("c_custkey", *_CUSTOMER_FIELDS),
            F.col("o_custkey") == F.col("c_custkey"),
            "left",
        )
    return rows.select(*[F.expr(COLUMN_SQL[c]).alias(c) for c in wanted])


def loans_sql() -> str:
    """The same table as a query for the checking engine."""
    columns = ",\n  ".join(f"{sql} AS {name}" for name, sql in COLUMN_SQL.items())
    return (
        f"SELECT {columns}\nFROM orders LEFT JOIN customer ON o_custkey = c_custkey\n"
        "LEFT JOIN (SELECT l_orderkey, count(*) AS n_lines,\n"
        "  count(*) FILTER (WHERE l_returnflag = 'R') AS n_ret, max(l_extendedprice) AS max_price\n"
        "  FROM lineitem GROUP BY l_orderkey) per_order ON o_orderkey = l_orderkey"
    )
