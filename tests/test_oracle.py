"""Every registered query against its independent SQL."""

import pytest

import __spark_entry__
import compare

from feira import registry
from oracle.selects import ORACLE

QUERIES = registry.queries()


@pytest.fixture(scope="module")
def con(folder):
    return compare.connect(folder)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(__spark_entry__.queries()) and set(ORACLE) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, folder, con, name):
    assert compare.difference(QUERIES[name](spark, folder), con, ORACLE[name]) is None


def test_entry_has_rows(spark):
    assert __spark_entry__.entry(spark).count() > 0
