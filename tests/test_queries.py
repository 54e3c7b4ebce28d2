"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import os
import re

import pytest

import __spark_entry__ as driver
from siltwork.queries import ORACLES, QUERIES
from tests.oracle import connect, difference

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

CALENDAR = {
    "clicks_by_month", "clicks_by_month_per_year", "income_by_date_profit", "income_vs_month_avg",
    "income_vs_own_month_avg", "gold_income_by_dates_with_month", "gold_income_by_avg_month", "gold_refreshed_dates_with_month",
}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def database():
    return connect(FOLDER)


def test_entry_has_rows(spark):
    assert driver.entry(spark).count() > 0


def test_every_sql_has_its_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, database, name):
    frame = QUERIES[name](spark, FOLDER)
    if name in ORACLES:
        assert difference(frame, database, ORACLES[name]) is None
    else:
        assert frame.count() > 0
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BatchEvalPython" not in plan and "NestedLoop" not in plan
    # A window without a partition key is one task: allowed over calendar
    # periods and over the sizes of range partitions, never over rows.
    for line in plan.splitlines():
        if re.search(r"Window \[", line) and name not in CALENDAR:
            assert "_size" in line
