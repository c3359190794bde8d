import pytest
from check_queries import compare

import __spark_entry__ as entry

ORACLES = entry.oracle_sql()
QUERIES = entry.queries()
ROWS_ONLY = sorted(set(QUERIES) - set(ORACLES))


def test_entry_has_rows_and_schema(spark):
    df = entry.entry(spark)
    assert df.columns == ["grade", "n", "mean_rate", "default_rate"]
    assert df.count() == 7


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf_dir, duck, name):
    assert compare(QUERIES[name](spark, sf_dir), duck, ORACLES[name]) is None


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_query_without_sql_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0
