"""Every query with a SQL twin equals it on the smallest tables."""

import pytest

import __spark_entry__ as entry_module
from tests.compare import connect, differences, type_differences

TWINS = entry_module.oracle_sql()


@pytest.fixture(scope="module")
def db(tiny):
    return connect(tiny)


@pytest.mark.parametrize("name", sorted(TWINS))
def test_equals_sql(spark, db, tiny, name):
    df = entry_module.queries()[name](spark, tiny)
    relation = db.sql(TWINS[name])
    assert differences(df, relation) is None
    assert type_differences(df, relation) == []


def test_entry(spark):
    assert entry_module.entry(spark).count() == 9
