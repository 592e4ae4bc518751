"""Every registered query against its SQL on the smallest data."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
import workload
from tests.conftest import TESTDATA
from tools.check_oracle import compare, duck

SF_DIR = str(TESTDATA / "sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", list(workload.QUERIES))
def test_query_equals_its_sql(spark, con, name):
    agrees, note = compare(spark, con, name, SF_DIR)
    assert agrees, note


def test_every_sql_belongs_to_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_entry_has_rows(spark):
    assert driver.entry(spark).count() == 3
