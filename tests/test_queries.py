"""Every registered query beside its SQL, on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from tallyguard.plans.oracles import ORACLES  # noqa: E402
from tallyguard.plans.registry import registered  # noqa: E402
from compare import compare, duck  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def tables():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert set(registered()) == set(ORACLES)
    assert {*registered()} <= {*entry.queries()} and {*ORACLES} <= {*entry.oracle_sql()}


@pytest.mark.parametrize("name", sorted(registered()))
def test_query_equals_sql(spark, tables, name):
    problem, rows = compare(spark, tables, SF_DIR, entry.queries()[name], entry.oracle_sql()[name])
    assert problem is None
    assert rows > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
