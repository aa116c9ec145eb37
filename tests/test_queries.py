"""Every registered query equals its SQL counterpart on the smallest tables."""

import pytest
from check_queries import compare, connect

import __spark_entry__ as entry_file

FOLDER = "/root/testdata/sf0.001"
QUERIES = entry_file.queries()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_counterpart_has_a_query():
    assert set(entry_file.oracle_sql()) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    result = compare(spark, duck, QUERIES[name], entry_file.oracle_sql().get(name), FOLDER)
    assert result.startswith(("ok", "rows only")), result


def test_entry_runs(spark):
    assert entry_file.entry(spark).limit(5).count() == 5
