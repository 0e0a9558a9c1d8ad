import pytest
from compare import same

from kinfold.llm.queries import QUERIES
from kinfold.llm.sql import SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, data, duck, name):
    same(QUERIES[name](spark, data), duck, SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_rows(spark, data, name):
    assert QUERIES[name](spark, data).count() > 0


def test_entry_has_them():
    import __spark_entry__

    assert set(QUERIES) <= set(__spark_entry__.queries())
