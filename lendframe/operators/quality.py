"""Quality checks that return issue rows, and the verdict over them.

Issue rows share one layout: (check, column, severity, observed, limit). Severity is "error" or
"warning"; a check that passes yields no row. `write_checked` takes the facts from the pass that writes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendframe.operators.profile import duplicate_rows, percent, target_mix
from lendframe.schema import ID, LOAN_RULES, RuleSet

ISSUE = "check string, column string, severity string, observed double, limit double"
CHECKS = ("schema", "nulls", "ranges", "categories", "statistics")
# Fixed value: share of the null limit from which a warning is given.
NEAR_LIMIT = 0.8


def _issues(df: DataFrame, check: str) -> DataFrame:
    return df.select(
        F.lit(check).alias("check"),
        "column",
        "severity",
        F.col("observed").cast("double").alias("observed"),
        F.col("limit").cast("double").alias("limit"),
    )


def _fits(kind: str, t: T.DataType) -> bool:
    if kind == "numeric":
        return isinstance(t, (T.DoubleType, T.FloatType, T.LongType, T.IntegerType))
    return isinstance(t, (T.StringType, T.BooleanType))


class Facts:
    """Measures gathered for several checks at once, and the issue rows built from them.

    All measures are columns of one aggregate over the table, so any number of these checks reads it a
    single time.
    """

    def __init__(self, df: DataFrame):
        self.df = df
        self.measures: dict[str, Column] = {"rows": F.count(F.lit(1))}
        self.entries: list[Column] = []

    def measure(self, name: str, value: Column) -> Column:
        self.measures[name] = value
        return F.col(f"`{name}`")

    def nulls(self, c: str) -> Column:
        return self.measure(f"nulls of {c}", F.count_if(F.col(f"`{c}`").isNull()))

    def add(self, check: str, column: str | None, severity: Column, observed: Column, limit: float | None) -> None:
        """An issue row; none is made where `severity` is NULL."""
        self.entries.append(
            F.struct(
                F.lit(check).alias("check"),
                F.lit(column).cast("string").alias("column"),
                severity.alias("severity"),
                observed.cast("double").alias("observed"),
                F.lit(limit).cast("double").alias("limit"),
            )
        )

    def rows(self) -> DataFrame:
        if not self.entries:
            return self.df.sparkSession.createDataFrame([], ISSUE)
        return self.found_in(self.df.agg(*self.aggregates()))

    def aggregates(self) -> list[Column]:
        return [m.alias(n) for n, m in self.measures.items()]

    def found_in(self, measured: DataFrame) -> DataFrame:
        """Issue rows from one row of all measures."""
        found = measured.select(F.explode(F.array(*self.entries)).alias("r")).select("r.*")
        return found.filter("severity IS NOT NULL")


def _empty_facts(facts: Facts) -> None:
    facts.add("empty", None, F.when(F.col("rows") == 0, "error"), F.col("rows"), 1.0)


def _schema_facts(facts: Facts, rules: RuleSet) -> None:
    present = {f.name: f.dataType for f in facts.df.schema}
    for c in rules.required:
        if c not in present:
            facts.add("schema_missing", c, F.lit("error"), F.lit(None), None)
    for c in present:
        if c not in rules.required:
            facts.add("schema_extra", c, F.lit("warning"), F.col("rows") - facts.nulls(c), None)
    for c, kind in rules.required.items():
        if c in present and not _fits(kind, present[c]):
            facts.add("schema_type", c, F.lit("warning"), F.col("rows") - facts.nulls(c), None)


def _null_facts(facts: Facts, rules: RuleSet) -> None:
    for c in facts.df.columns:
        limit = rules.null_limits.get(c, rules.default_null_limit)
        share = percent(facts.nulls(c), F.col("rows"))
        severity = F.when(share > limit, "error").when(share > limit * NEAR_LIMIT, "warning")
        facts.add("nulls", c, severity, share, limit)


def _range_facts(facts: Facts, rules: RuleSet) -> None:
    numeric = {f.name for f in facts.df.schema if isinstance(f.dataType, T.NumericType)}
    for c, (low, high) in rules.ranges.items():
        if c not in numeric:
            continue
        if low is not None:
            below = facts.measure(f"below {c}", F.count_if(F.col(c) < low))
            facts.add("ranges", c, F.when(below > 0, "error"), below, low)
        if high is not None:
            above = facts.measure(f"above {c}", F.count_if(F.col(c) > high))
            facts.add("ranges", c, F.when(above > 0, "warning"), above, high)


def check_schema(df: DataFrame, rules: RuleSet = LOAN_RULES) -> DataFrame:
    """Missing required columns are errors; extra columns and wrong type families are warnings.

    One row per column, so several missing columns are several errors. `observed` is the number of
    values found in the column.
    """
    facts = Facts(df)
    _schema_facts(facts, rules)
    return facts.rows()


def check_nulls(df: DataFrame, rules: RuleSet = LOAN_RULES) -> DataFrame:
    """Percent of NULLs above the column's limit is an error, above 80% of it a warning."""
    facts = Facts(df)
    _null_facts(facts, rules)
    return facts.rows()


def check_ranges(df: DataFrame, rules: RuleSet = LOAN_RULES) -> DataFrame:
    """Values below the minimum are an error, above the maximum a warning; `observed` is their count.

    Bounds are inclusive, NULL is ignored and columns that are not numeric are skipped.
    """
    facts = Facts(df)
    _range_facts(facts, rules)
    return facts.rows()


def unexpected_values(df: DataFrame, rules: RuleSet = LOAN_RULES) -> DataFrame:
    """(column, value, n): every value outside its column's allowed set."""
    names = [c for c in rules.allowed if c in df.columns]
    if not names:
        return df.sparkSession.createDataFrame([], "column string, value string, n bigint")
    allowed = df.sparkSession.createDataFrame(
        [(c, v) for c in names for v in rules.allowed[c]], "column string, value string"
    )
    seen = (
        df.select(*[F.col(c).cast("string").alias(c) for c in names])
        .unpivot([], names, "column", "value")
        .filter("value IS NOT NULL")
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return seen.join(F.broadcast(allowed), ["column", "value"], "left_anti")


def check_categories(df: DataFrame, rules: RuleSet = LOAN_RULES) -> DataFrame:
    """One warning per column that holds unexpected values; `observed` is how many distinct ones."""
    rows = (
        unexpected_values(df, rules)
        .groupBy("column")
        .agg(F.count(F.lit(1)).alias("observed"))
        .withColumns({"severity": F.lit("warning"), "limit": F.lit(0.0)})
    )
    return _issues(rows, "categories")


def check_duplicates(df: DataFrame, rules: RuleSet = LOAN_RULES) -> DataFrame:
    """Equal rows under different row keys count as repeats."""
    rows = duplicate_rows(df.drop(ID)).select(
        F.lit(None).cast("string").alias("column"),
        F.lit("warning").alias("severity"),
        F.col("percent").alias("observed"),
        F.lit(rules.duplicate_limit).alias("limit"),
    )
    return _issues(rows.filter(F.col("observed") > F.col("limit")), "duplicates")


def check_imbalance(df: DataFrame, rules: RuleSet = LOAN_RULES) -> DataFrame:
    if rules.target not in df.columns:
        return df.sparkSession.createDataFrame([], ISSUE)
    rows = target_mix(df, rules.target).agg(F.min("percent").alias("observed")).withColumns(
        {
            "column": F.lit(rules.target),
            "severity": F.lit("warning"),
            "limit": F.lit(rules.minority_limit),
        }
    )
    return _issues(rows.filter(F.col("observed") < F.col("limit")), "imbalance")


def issues(
    df: DataFrame, rules: RuleSet = LOAN_RULES, checks: tuple[str, ...] = CHECKS
) -> DataFrame:
    """All issue rows of the chosen checks; an empty table is always an error.

    Schema, NULL and range checks share one read of the table.
    """
    facts = Facts(df)
    _empty_facts(facts)
    if "schema" in checks:
        _schema_facts(facts, rules)
    if "nulls" in checks:
        _null_facts(facts, rules)
    if "ranges" in checks:
        _range_facts(facts, rules)
    out = facts.rows()
    if "categories" in checks:
        out = out.unionByName(check_categories(df, rules))
    if "statistics" in checks:
        out = out.unionByName(check_duplicates(df, rules)).unionByName(check_imbalance(df, rules))
    return out


@dataclass(frozen=True)
class CheckedWrite:
    """What a checked write found: the written table, issue rows, and each value outside an allowed set."""

    table: DataFrame
    issues: DataFrame
    offenders: DataFrame


def write_checked(
    df: DataFrame, path: str, rules: RuleSet = LOAN_RULES, checks: tuple[str, ...] = CHECKS, mode: str = "errorifexists"
) -> CheckedWrite:
    """Write `df` as Parquet and check it in the same pass; issues are those of `issues`.

    Row, NULL and range counts and the number of values outside allowed sets are observed while the rows
    pass to the files, in the stage that writes, whose tasks count once however often they are tried. `df` is computed
    once. Afterwards only what needs grouping reads the written columns: the columns that hold
    offenders, repeated rows, and the target.
    """
    spark = df.sparkSession
    facts = Facts(df)
    _empty_facts(facts)
    for check, add in (("schema", _schema_facts), ("nulls", _null_facts), ("ranges", _range_facts)):
        if check in checks:
            add(facts, rules)
    limited = [c for c in rules.allowed if c in df.columns] if "categories" in checks else []
    for c in limited:
        facts.measure(f"outside {c}", F.count_if(~F.col(f"`{c}`").cast("string").isin(list(rules.allowed[c]))))
    watch = Observation()
    df.observe(watch, *facts.aggregates()).write.mode(mode).parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    seen = watch.get
    # A plan that Spark proves empty passes no row to observe.
    seen = {name: seen.get(name) or 0 for name in facts.measures}
    measured = spark.createDataFrame([tuple(seen.values())], ", ".join(f"`{n}` bigint" for n in seen))
    found = facts.found_in(measured)
    offending = [c for c in limited if seen[f"outside {c}"]]
    offenders = unexpected_values(table.select(*offending), rules)
    if offending:
        found = found.unionByName(check_categories(table.select(*offending), rules))
    if "statistics" in checks:
        found = found.unionByName(check_duplicates(table, rules)).unionByName(check_imbalance(table, rules))
    return CheckedWrite(table, found, offenders)


def verdict(found: DataFrame, strict: bool = False) -> DataFrame:
    """(is_valid, errors, warnings): valid without errors, and without warnings too when strict."""
    ok = F.col("errors") == 0
    if strict:
        ok = ok & (F.col("warnings") == 0)
    counted = found.agg(
        F.count_if(F.col("severity") == "error").alias("errors"),
        F.count_if(F.col("severity") == "warning").alias("warnings"),
    )
    return counted.select(ok.alias("is_valid"), "errors", "warnings")


def validate(
    df: DataFrame,
    rules: RuleSet = LOAN_RULES,
    strict: bool = False,
    checks: tuple[str, ...] = CHECKS,
) -> tuple[DataFrame, DataFrame]:
    """(issue rows, verdict)."""
    found = issues(df, rules, checks)
    return found, verdict(found, strict)
