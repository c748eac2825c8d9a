"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tidegrid.plans.catalog import QUERIES
from tidegrid.plans.oracles import WITHOUT_SQL, oracle_sql
from tools.check import compare, database

SQL = oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return database(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, sf_dir, name):
    assert compare(spark, con, sf_dir, name, SQL[name]) is None


@pytest.mark.parametrize("name", WITHOUT_SQL)
def test_query_without_sql_has_rows(spark, sf_dir, name):
    assert entry.queries()[name](spark, sf_dir).count() > 0


def test_every_query_is_accounted_for():
    assert set(QUERIES) == set(SQL) | set(WITHOUT_SQL) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 15
