"""Every registered query against its SQL on the smallest tables."""

import pytest
from oracle_check import compare, connect

from corpusprep.plans.catalog import QUERIES
from corpusprep.plans.oracle import ORACLE
from corpusprep.plans.round_trips import QUERIES as ROUND_TRIPS

SF_DIR = "/root/testdata/sf0.001"
ALL = QUERIES | ROUND_TRIPS


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(ALL) == set(ORACLE)


@pytest.mark.parametrize("name", ALL)
def test_query_matches_sql(spark, con, name):
    assert compare(spark, con, SF_DIR, ALL[name], ORACLE[name]) is None
