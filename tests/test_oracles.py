"""Every registered query against its SQL."""

import compare
import pytest

import __spark_entry__ as entry
from tickloom.registry import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return compare.connection(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf_dir, name):
    assert compare.difference(spark, duck, QUERIES[name], ORACLES[name], sf_dir) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["record_id", "report_date", "coin_id"]
    assert df.count() == 150
