"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entries
from catalogue.oracles import ORACLES
from catalogue.queries import QUERIES
from tools.check import difference, oracle_connection

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(SF_DIR)


@pytest.mark.parametrize("name", sorted(entries.oracle_sql()))
def test_query_matches_its_sql(spark, connection, name):
    assert difference(spark, connection, name, SF_DIR) is None


def test_every_query_of_the_catalogue_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(entries.oracle_sql()) <= set(entries.queries())


def test_flagship_query_inserts_rows(spark):
    assert entries.entry(spark).count() > 0
