"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
from tablekit.suite import CASES
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", list(CASES))
def test_query_agrees_with_sql(spark, duck, name):
    assert compare(spark, duck, name, SF) == []


def test_driver_contract(spark):
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert driver.entry(spark).count() == 4
    without = set(CASES) - set(driver.oracle_sql())
    assert without == {"list_files"}
