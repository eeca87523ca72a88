"""Every named query: equal to its SQL twin, or at least runs with a stable schema."""

import os

import pytest

from quarry.catalog import all_queries
from tests.oracle import difference

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = all_queries()


@pytest.mark.parametrize("name", sorted(n for n, q in QUERIES.items() if q.sql))
def test_equals_sql(spark, name):
    assert difference(spark, FOLDER, QUERIES[name]) is None


@pytest.mark.parametrize("name", sorted(n for n, q in QUERIES.items() if not q.sql))
def test_runs(spark, name):
    df = QUERIES[name].run(spark, FOLDER)
    assert df.columns and df.count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns == ["bucket", "n"]
