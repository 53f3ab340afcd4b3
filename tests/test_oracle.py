"""Every registered query against its SQL twin."""

import inspect

import pytest

import __spark_entry__ as entry
from catalogue.registry import ORACLE, QUERIES
from tools.check_oracle import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert compare(spark, con, name, SF) is None


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "repo_name" and 0 < df.count() <= 200


def test_callables_take_session_and_folder():
    for q in entry.queries().values():
        assert len(inspect.signature(q).parameters) == 2
