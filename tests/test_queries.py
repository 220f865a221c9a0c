"""Every registered query beside its SQL, on the smallest tables."""

import pytest
from check_oracles import connect, duck_rows, spark_rows

import __spark_entry__ as entry
from quadloom.plans.catalog import QUERIES

SF_DIR = "/root/testdata/sf0.001"
# Operators without SQL are tested in their own folder.
OWN = {name for name in entry.queries() if name not in QUERIES}


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(entry.queries()) - set(entry.oracle_sql()) <= OWN
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    got = spark_rows(entry.queries()[name](spark, SF_DIR))
    assert got == duck_rows(con, entry.oracle_sql()[name])
