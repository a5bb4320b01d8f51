"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from lodgegrid.plans.queries import all_queries

from .oracle_check import database, differences

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return database(FOLDER)


@pytest.mark.parametrize("name", list(all_queries()))
def test_query_equals_its_sql(spark, connection, name):
    assert differences(spark, connection, FOLDER, name) == []


def test_every_query_has_sql():
    assert all_queries().keys() <= entry.oracle_sql().keys()


def test_entry(spark):
    assert entry.entry(spark).count() > 0
