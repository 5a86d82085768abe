"""Every registered query against its SQL, and the others for rows."""

import pytest
from compare import duck, duck_rows, spark_rows

import __spark_entry__ as driver

QUERIES, ORACLE = driver.queries(), driver.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_reference_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_reference_sql(spark, sf_dir, con, name):
    columns, rows = spark_rows(QUERIES[name](spark, sf_dir))
    expected_columns, expected = duck_rows(con, ORACLE[name])
    assert columns == expected_columns
    assert rows == expected


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).collect()


def test_entry(spark):
    results = driver.entry(spark).collect()
    failing = {(r.source_table_id, r.metric_column, r.rule_family): r.failed_rows for r in results if r.status == "FAIL"}
    assert failing["lineitem", "l_orderkey", "Uniqueness"] == 1365
    assert failing["orders_dirty", "o_orderkey", "Uniqueness"] == 19
    assert not [r for r in results if r.status == "ERROR"]
