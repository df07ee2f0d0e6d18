"""Every query of the package that SQL can express, against its SQL counterpart."""

from __future__ import annotations

import pytest
from compare import connect, spark_rows, sql_rows
from conftest import SF_DIR

from fleetlake.llm.queries import ORACLE_SQL, QUERIES


@pytest.fixture(scope="module")
def sql():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query(spark, sql, name):
    columns, rows = spark_rows(QUERIES[name](spark, SF_DIR))
    expected_columns, expected = sql_rows(sql, ORACLE_SQL[name])
    assert columns == expected_columns
    assert rows == expected
