"""Pipeline operators that SQL can express, against their SQL."""

from __future__ import annotations

import pytest

from tallyloom.llm.catalog import REGISTRY
from tallyloom.llm.oracle import ORACLE
from tests.compare import differences, duck, rows_of_duck, rows_of_spark
from tests.conftest import TINY


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    assert differences(rows_of_spark(REGISTRY[name](spark, TINY)), rows_of_duck(duck(TINY), ORACLE[name])) == []
