import pytest
from compare import same

from kinfold.plans import catalogue

SQL = catalogue.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, data, duck, name):
    same(catalogue.queries()[name](spark, data), duck, SQL[name])


@pytest.mark.parametrize("name", sorted(set(catalogue.queries()) - set(SQL)))
def test_rows(spark, data, name):
    df = catalogue.queries()[name](spark, data)
    assert len(set(df.columns)) == len(df.columns)
    assert df.count() > 0


def test_without_training_data_operators(spark):
    import pathlib

    for p in pathlib.Path(catalogue.__file__).parents[1].rglob("*.py"):
        assert "llm" in p.parts or "kinfold.llm" not in p.read_text()
