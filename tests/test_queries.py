"""Every registered query against its SQL on the smallest data."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from check import compare
from workload.queries import QUERIES
from workload.sql import ORACLE

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test data")


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, name):
    problem, rows = compare(spark, str(DATA), name)
    assert not problem
    assert rows > 0


def test_flagship(spark):
    wide = entry.entry(spark)
    assert wide.columns[0] == "COUNTRY/REGION" and len(wide.columns) == 22
    assert wide.count() > 0
