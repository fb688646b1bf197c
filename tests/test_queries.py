import os

import pytest
from compare import SF, duck, same

from poselake.plans import queries as Q

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return duck()


@pytest.mark.parametrize("name", sorted(Q.queries()))
def test_query_against_sql(spark, con, name):
    df = Q.queries()[name](spark, SF)
    if name in Q.oracle_sql():
        same(df, con, Q.oracle_sql()[name])
    else:
        df.collect()


def test_entry_runs_without_optional_parts(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns and set(Q.queries()) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
