"""Loan table layout, quality rules and feature lists.

Everything in this module is a fixed value: column names, limits and labels that results
have to agree on. Nothing here runs a job.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# The raw loan table, in file order. `loan_id` is ours; it replaces row position.
_RAW = [
    ("loan_id", "bigint"),
    ("loan_amnt", "double"),
    ("term", "string"),
    ("int_rate", "double"),
    ("installment", "double"),
    ("grade", "string"),
    ("sub_grade", "string"),
    ("emp_title", "string"),
    ("emp_length", "string"),
    ("home_ownership", "string"),
    ("annual_inc", "double"),
    ("verification_status", "string"),
    ("issue_d", "date"),
    ("loan_status", "string"),
    ("purpose", "string"),
    ("title", "string"),
    ("dti", "double"),
    ("earliest_cr_line", "string"),
    ("open_acc", "double"),
    ("pub_rec", "double"),
    ("revol_bal", "double"),
    ("revol_util", "double"),
    ("total_acc", "double"),
    ("initial_list_status", "string"),
    ("application_type", "string"),
    ("mort_acc", "double"),
    ("pub_rec_bankruptcies", "double"),
    ("address", "string"),
]
_TYPES = {
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "date": T.DateType(),
}
LOAN_SCHEMA = T.StructType([T.StructField(n, _TYPES[t], True) for n, t in _RAW])
RAW_COLUMNS = [n for n, _ in _RAW]

ID = "loan_id"
TARGET = "loan_status"
TARGET_CODES = {"Charged Off": 0, "Fully Paid": 1}

# Columns that preparation drops.
DROPPED = [
    "Unnamed: 0",
    "emp_title",
    "title",
    "address",
    "issue_d",
    "sub_grade",
    "application_type",
    "revol_bal",
]
ETL_DROPPED = [c for c in DROPPED if c != "revol_bal"]

# Model inputs.
CATEGORICAL = [
    "term",
    "grade",
    "emp_length",
    "home_ownership",
    "verification_status",
    "purpose",
    "pub_rec",
    "initial_list_status",
    "pub_rec_bankruptcies",
]
NUMERIC = [
    "int_rate",
    "annual_inc",
    "dti",
    "revol_util",
    "mort_acc",
    "loan_to_income",
    "total_interest_owed",
    "installment_to_income_ratio",
    "active_credit_pct",
    "credit_age",
]
# Order of the prepared table.
PREPARED = [
    "term",
    "int_rate",
    "grade",
    "emp_length",
    "home_ownership",
    "annual_inc",
    "verification_status",
    "purpose",
    "dti",
    "pub_rec",
    "revol_util",
    "initial_list_status",
    "mort_acc",
    "pub_rec_bankruptcies",
    "loan_to_income",
    "total_interest_owed",
    "installment_to_income_ratio",
    "active_credit_pct",
    "credit_age",
]
MEDIAN_FILLED = ["mort_acc", "revol_util", "pub_rec_bankruptcies"]

# Bucket edges (right-closed) and labels.
DTI_EDGES = [0.0, 10.0, 20.0, 30.0, 40.0, 100.0]
DTI_LABELS = ["very_low", "low", "medium", "high", "very_high"]
INCOME_EDGES = [0.0, 30000.0, 50000.0, 75000.0, 100000.0, 150000.0, float("inf")]
INCOME_LABELS = ["very_low", "low", "medium", "high", "very_high", "top"]

# Fixed value: a feature whose population-stability index exceeds this is reported as drifted.
DRIFT_ALERT = 0.1


@dataclass(frozen=True)
class RuleSet:
    """Quality rules checked by `lendframe.operators.quality`; pass your own to replace them."""

    required: dict[str, str] = field(default_factory=dict)
    ranges: dict[str, tuple[float | None, float | None]] = field(default_factory=dict)
    allowed: dict[str, tuple[str, ...]] = field(default_factory=dict)
    null_limits: dict[str, float] = field(default_factory=dict)
    default_null_limit: float = 20.0
    duplicate_limit: float = 5.0
    minority_limit: float = 5.0
    target: str = TARGET


# The loan rules.
LOAN_RULES = RuleSet(
    required={
        "loan_amnt": "numeric",
        "term": "text",
        "int_rate": "numeric",
        "installment": "numeric",
        "grade": "text",
        "emp_length": "text",
        "home_ownership": "text",
        "annual_inc": "numeric",
        "verification_status": "text",
        "loan_status": "text",
        "purpose": "text",
        "dti": "numeric",
        "open_acc": "numeric",
        "pub_rec": "numeric",
        "revol_bal": "numeric",
        "revol_util": "numeric",
        "total_acc": "numeric",
        "initial_list_status": "text",
        "mort_acc": "numeric",
        "pub_rec_bankruptcies": "numeric",
    },
    ranges={
        "loan_amnt": (0.0, 1000000.0),
        "int_rate": (0.0, 100.0),
        "annual_inc": (0.0, 50000000.0),
        "dti": (0.0, 100.0),
        "revol_util": (0.0, 200.0),
        "open_acc": (0.0, 100.0),
        "total_acc": (0.0, 200.0),
    },
    allowed={
        "term": (" 36 months", " 60 months"),
        "grade": ("A", "B", "C", "D", "E", "F", "G"),
        "home_ownership": ("RENT", "OWN", "MORTGAGE", "OTHER", "NONE", "ANY"),
        "verification_status": ("Verified", "Source Verified", "Not Verified"),
        "loan_status": ("Fully Paid", "Charged Off"),
        "initial_list_status": ("f", "w"),
    },
    null_limits={
        "loan_amnt": 0.0,
        "int_rate": 0.0,
        "annual_inc": 0.0,
        "loan_status": 0.0,
        "emp_length": 10.0,
        "mort_acc": 15.0,
        "revol_util": 1.0,
        "pub_rec_bankruptcies": 1.0,
    },
)

# Bounds on a single application, (low, high, required).
REQUEST_BOUNDS = {
    "loan_amnt": (0.0, None, True),
    "term": (None, None, True),
    "int_rate": (0.0, 100.0, True),
    "installment": (0.0, None, True),
    "grade": (None, None, True),
    "home_ownership": (None, None, True),
    "annual_inc": (0.0, None, True),
    "verification_status": (None, None, True),
    "purpose": (None, None, True),
    "dti": (0.0, None, True),
    "open_acc": (0.0, None, True),
    "pub_rec": (0.0, None, False),
    "revol_bal": (0.0, None, False),
    "total_acc": (0.0, None, True),
}
# What an application gets when it leaves these fields out.
REQUEST_DEFAULTS = {"pub_rec": 0.0, "revol_bal": 0.0, "initial_list_status": "f"}
