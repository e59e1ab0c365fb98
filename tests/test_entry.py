"""The registered queries against their SQL, on the smallest tables."""

from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from odotrack.plans.queries import all_queries
from oracle_check import compare, connect
from oracles import all_oracles

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def database():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(all_queries()) <= set(oracle_sql())
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(all_oracles()))
def test_query(spark, database, name):
    got, wanted, different, *_ = compare(spark, database, name, FOLDER)
    assert len(got) == len(wanted)
    assert not different, different[:3]


def test_entry(spark):
    assert entry(spark).count() > 0
