"""Every registered query against its SQL on the smallest data."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

import check  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def database():
    return check.database(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_equals_sql(spark, database, name):
    verdict = check.compare(spark, database, FOLDER, name)
    assert verdict.startswith(("ok", "rows")) and "TYPES" not in verdict, verdict


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns[0] == "mrid"
