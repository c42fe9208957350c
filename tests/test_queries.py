import os

import pytest

from gridloom import queries

from .compare import connect, same

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are missing")
@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query_equals_sql(spark, con, name):
    same(spark, con, queries.QUERIES[name], queries.ORACLE[name], SF)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
