"""Every registered query against its SQL counterpart, on the smallest data."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
from tallyloom.plans.catalog import REGISTRY
from tallyloom.plans.oracle import ORACLE as SQL
from tests.compare import differences, duck, rows_of_duck, rows_of_spark
from tests.conftest import TINY

QUERIES, ORACLE = REGISTRY, SQL


@pytest.fixture(scope="module")
def con():
    return duck(TINY)


def test_every_sql_text_has_a_query():
    assert set(ORACLE) <= set(QUERIES) <= set(driver.queries())
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert set(QUERIES) - set(ORACLE) == {"gbt_forecast", "gbt_feature_importance", "store_clusters"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, name):
    assert differences(rows_of_spark(QUERIES[name](spark, TINY)), rows_of_duck(con, ORACLE[name])) == []


def test_entry_has_rows(spark):
    result = driver.entry(spark)
    assert result.columns[0] == "store_id" and result.count() > 0
