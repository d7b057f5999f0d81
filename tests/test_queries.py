"""Every registered query against its SQL."""

import os

import pytest

import __spark_entry__ as entry
from checks.register import ORACLES, QUERIES
from tests.compare import connect, kind, rows

SF_DIR = os.environ.get("CURATE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    connection = connect(SF_DIR)
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(name, spark, duck):
    found = QUERIES[name](spark, SF_DIR)
    wanted = duck.execute(ORACLES[name])
    names = [column[0] for column in wanted.description]
    types = {column[0]: kind(column[1]) for column in wanted.description}
    assert {column: kind(type_) for column, type_ in found.dtypes} == types
    assert rows(found.columns, [tuple(row) for row in found.collect()]) == rows(names, wanted.fetchall())
