"""Queries that write tables give the same rows when they run again in one folder."""

import pytest
from conftest import rows_of

from checks import catalog

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog.registered()))
def test_every_query_runs_twice(spark, name):
    query = catalog.registered()[name]
    first = rows_of(query(spark, SF))
    assert rows_of(query(spark, SF)) == first
