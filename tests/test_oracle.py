"""Every registered query against its SQL twin, on the smallest tables."""

import pytest

import __spark_entry__
from __spark_entry__ import entry
from bazaarline.plans.oracle import oracle
from bazaarline.plans.queries import QUERIES as RUNS
from check import compare, connect
from conftest import SMALL

SQL = oracle()


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_entry_registers_them_all():
    assert set(RUNS) <= set(__spark_entry__.queries()) and set(SQL) <= set(__spark_entry__.oracle_sql())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_every_sql_has_a_query():
    assert set(SQL) <= set(RUNS)
    assert set(RUNS) - set(SQL) == {"forecast_window_regression", "forecast_recurrent", "boundary_score_nu"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    assert compare(RUNS[name](spark, SMALL), con, SQL[name]) == ""


@pytest.mark.parametrize("name", sorted(set(RUNS) - set(SQL)))
def test_query_without_sql_has_rows(spark, name):
    assert RUNS[name](spark, SMALL).count() > 0


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", ["build_features", "outlier_iqr", "isolation_score", "impute_interpolate", "evaluate_forecasts"])
def test_partitioning_does_not_matter(spark, name):
    before = sorted(map(str, RUNS[name](spark, SMALL).collect()))
    width = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        assert sorted(map(str, RUNS[name](spark, SMALL).collect())) == before
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", width)
