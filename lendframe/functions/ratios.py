"""Derived loan features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lendframe.functions.cleaning import credit_line_date
from lendframe.schema import DTI_EDGES, DTI_LABELS, INCOME_EDGES, INCOME_LABELS


def loan_to_income() -> Column:
    return F.try_divide(F.col("loan_amnt"), F.col("annual_inc"))


def total_interest_owed() -> Column:
    return F.col("loan_amnt") * (F.col("int_rate") / F.lit(100.0))


def installment_to_income_ratio() -> Column:
    return F.try_divide(F.col("installment"), F.col("annual_inc") / F.lit(12.0))


def active_credit_pct() -> Column:
    total = F.col("total_acc")
    return F.when(total > 0, F.try_divide(F.col("open_acc"), total))


def credit_age(as_of_year: int) -> Column:
    return (F.lit(as_of_year) - F.year(credit_line_date(F.col("earliest_cr_line")))).cast("double")


def right_closed(c: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the interval (lo, hi] that holds `c`; NULL outside all of them."""
    out = F.lit(None).cast("string")
    for lo, hi, label in reversed(list(zip(edges, edges[1:], labels))):
        inside = c > F.lit(lo)
        if hi != float("inf"):
            inside = inside & (c <= F.lit(hi))
        out = F.when(inside, F.lit(label)).otherwise(out)
    return out


def dti_bucket() -> Column:
    return right_closed(F.col("dti"), DTI_EDGES, DTI_LABELS)


def income_bucket() -> Column:
    return right_closed(F.col("annual_inc"), INCOME_EDGES, INCOME_LABELS)


def debt_burden_score() -> Column:
    share = F.try_divide(F.col("loan_amnt"), F.col("annual_inc"))
    return (
        F.col("dti") * F.lit(0.3)
        + F.coalesce(F.col("revol_util"), F.lit(0.0)) * F.lit(0.3)
        + share * F.lit(100.0) * F.lit(0.4)
    )


def payment_capacity() -> Column:
    monthly = F.col("annual_inc") / F.lit(12.0)
    return F.try_divide(monthly - F.col("installment"), monthly + F.lit(1.0))
