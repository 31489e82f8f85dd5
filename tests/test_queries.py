"""Every registered query against its SQL on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from check import compare, oracle  # noqa: E402
from furrow.plans.queries import all_queries  # noqa: E402

SF = "/root/testdata/sf0.001"
NAMES = sorted(all_queries())


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF):
        pytest.skip("no tables here")
    return oracle(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    verdict, _, _, ok = compare(spark, con, name, entry.queries()[name], entry.oracle_sql().get(name), SF)
    assert ok, verdict


def test_names_say_what_they_compute():
    assert not any("pipeline" in n or n.startswith("op") and n[2:3].isdigit() for n in NAMES)
    assert set(entry.oracle_sql()) <= set(entry.queries()) and set(NAMES) <= set(entry.queries())
