import datetime
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from check_queries import DATA, connect, session  # noqa: E402

from lendframe.schema import LOAN_RULES, LOAN_SCHEMA  # noqa: E402
from lendframe.session import tune  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return tune(session())


@pytest.fixture(scope="session")
def sf_dir():
    return f"{DATA}/sf0.001"


@pytest.fixture(scope="session")
def duck(sf_dir):
    return connect(sf_dir)


# Numbers lie between two ends, within the rules' ranges and touching them where the rules say "inclusive".
NUMBERS = {
    "loan_amnt": (0.5, 61_000.0), "int_rate": (0.0, 33.3), "installment": (12.5, 2_222.0), "annual_inc": (1.0, 410_000.0),
    "dti": (0.0, 100.0), "revol_bal": (0.0, 90_000.0), "revol_util": (0.0, 200.0),
}
COUNTS = {"open_acc": 44, "pub_rec": 6, "total_acc": 37, "mort_acc": 7, "pub_rec_bankruptcies": 4}
# Texts the rules do not list.
WORDS = {
    "sub_grade": ["C1", "F5"], "emp_title": ["Nurse", "Driver, night shift", "Ärztin"], "title": ["car", "  roof "],
    "purpose": ["car", "medical", "moving", "vacation", "wedding"], "application_type": ["Individual", "Joint App"],
    "address": ["9 Elm Rd, Apt 4", "Straße 7"],
    "emp_length": ["< 1 year", "1 year", *[f"{k} years" for k in range(2, 10)], "10+ years", "n/a"],
}
# One row in so many lacks the value: beyond the rules' limits for the first five, within them for the last.
GAPS = {"emp_title": 4, "title": 3, "emp_length": 7, "mort_acc": 6, "pub_rec_bankruptcies": 30, "revol_util": 250}


def place(i, j):
    """Row i's place between the ends of column j: evenly spread, in an order of its own per column."""
    return ((i + 1) * (0.6180339887498949 + 0.0137 * j)) % 1.0


def raw_loan(i):
    """The i-th raw loan, made from the rules; every row can be prepared."""
    row = {"loan_id": i, "issue_d": datetime.date(2021, 1 + i % 12, 1 + i % 28)}
    for j, field in enumerate(LOAN_SCHEMA):
        name, at = field.name, place(i, j)
        texts = LOAN_RULES.allowed.get(name) or WORDS.get(name)
        if name in GAPS and i % GAPS[name] == 1:
            row[name] = None
        elif name in NUMBERS:
            low, high = NUMBERS[name]
            row[name] = low if i == 0 else high if i == 2 else round(low + at * (high - low), 2)
        elif name in COUNTS:
            row[name] = 1.0 + int(at * COUNTS[name]) if name.endswith("_acc") else float(int(at * at * COUNTS[name]))
        elif texts:
            row[name] = texts[int(at * len(texts))]
    row["earliest_cr_line"] = datetime.date(1971 + i % 49, 1 + i % 12, 1).strftime("%b-%Y")
    late = 0.15 * (row["dti"] > 40) + 0.2 * (row["grade"] in "FG") + 0.1 * (row["term"] == " 60 months")
    row["loan_status"] = "Charged Off" if place(i, 71) < 0.05 + late else "Fully Paid"
    return tuple(row[f.name] for f in LOAN_SCHEMA)


@pytest.fixture(scope="session")
def raw(spark):
    return spark.createDataFrame([raw_loan(i) for i in range(1_000)], LOAN_SCHEMA).cache()


def loan(**changes):
    """One complete raw loan as a tuple in schema order."""
    row = dict(
        loan_id=1, loan_amnt=10000.0, term=" 36 months", int_rate=12.5, installment=335.47, grade="B",
        sub_grade="B2", emp_title="Clerk", emp_length="5 years", home_ownership="RENT", annual_inc=60000.0,
        verification_status="Verified", issue_d=None, loan_status="Fully Paid", purpose="debt_consolidation",
        title=None, dti=15.5, earliest_cr_line="Jan-2010", open_acc=8.0, pub_rec=0.0, revol_bal=5000.0,
        revol_util=45.0, total_acc=15.0, initial_list_status="f", application_type="Individual",
        mort_acc=0.0, pub_rec_bankruptcies=0.0, address=None,
    )
    row.update(changes)
    return tuple(row[f.name] for f in LOAN_SCHEMA)


@pytest.fixture(scope="session")
def frame_of(spark):
    def build(*rows):
        return spark.createDataFrame([loan(loan_id=i, **r) for i, r in enumerate(rows)], LOAN_SCHEMA)

    return build
