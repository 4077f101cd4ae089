"""Every registered query against its SQL twin."""

import os

import pytest

import __spark_entry__ as entry
from oracle_check import compare, connect
from pointflow.plans.catalog import QUERIES
from pointflow.plans.oracles import ORACLES as OWN

FOLDER = os.environ.get("ORACLE_DIR", "/root/testdata/sf0.001")
ORACLES = entry.oracle_sql()
# their start or their draws are random, so there is no SQL for them
RANDOM_START = {"kmeans_fit", "kmeans_init", "fair_lloyd_auto"}


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_a_twin():
    assert set(QUERIES) - set(OWN) == RANDOM_START
    assert set(QUERIES) <= set(entry.queries()) and set(OWN) <= set(ORACLES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_twin(spark, con, name):
    same, _, _, _, detail = compare(spark, con, name, entry.queries()[name], ORACLES[name], FOLDER)
    assert same, detail


@pytest.mark.parametrize("name", sorted(RANDOM_START))
def test_random_start(spark, name):
    fn = entry.queries()[name]
    rows = sorted(map(tuple, fn(spark, FOLDER).collect()))
    assert len(rows) == 4 and rows == sorted(map(tuple, fn(spark, FOLDER).collect()))


def test_entry(spark):
    assert entry.entry(spark).count() == 4
