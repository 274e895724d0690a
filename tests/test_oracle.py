from pathlib import Path

import pytest

import __spark_entry__ as entry
from chondria.registry import ORACLE, QUERIES
from oracle_check import connect, differences

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    if not Path(SF).exists():
        pytest.skip("no driver tables")
    return connect(SF)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert differences(QUERIES[name](spark, SF), con, ORACLE[name]) == []


def test_entry(spark, con):
    assert entry.entry(spark).count() > 0
