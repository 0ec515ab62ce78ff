"""Every registered query beside its SQL check on the smallest test tables."""

from __future__ import annotations

import oracle_check
import pytest

import __spark_entry__ as entry
from carelens.bindings import catalog

SF_DIR = "/root/testdata/sf0.001"
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def database():
    return oracle_check.database(SF_DIR)


def test_every_query_has_a_check():
    assert set(catalog.queries()) == set(catalog.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_equals_sql(spark, database, name):
    query = entry.queries()[name]
    assert oracle_check.differences(spark, database, query, ORACLE[name], SF_DIR) is None
