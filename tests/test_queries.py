"""Every named query against its SQL counterpart in another engine."""

from __future__ import annotations

import pytest
from compare import connect, spark_rows, sql_rows
from conftest import SF_DIR

import __spark_entry__ as entry_points
from fleetlake.plans.oracle import ORACLE_SQL
from fleetlake.plans.reports import REPORTS


@pytest.fixture(scope="module")
def sql():
    return connect(SF_DIR)


def test_every_query_has_a_counterpart():
    assert set(REPORTS) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_query(spark, sql, name):
    columns, rows = spark_rows(REPORTS[name](spark, SF_DIR))
    expected_columns, expected = sql_rows(sql, ORACLE_SQL[name])
    assert columns == expected_columns
    assert rows == expected


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_sorted_reports_keep_their_order(spark, sql):
    for name in ("device_health", "queue_rank_high", "queue_rank_low", "open_incidents_ranked", "newest_incidents"):
        df = REPORTS[name](spark, SF_DIR)
        result = sql.execute(ORACLE_SQL[name])
        names = [d[0] for d in result.description]
        assert [tuple(r[c] for c in names) for r in df.collect()] == result.fetchall(), name
