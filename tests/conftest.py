import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from kinfold.session import get_session  # noqa: E402

DATA = os.environ.get("KINFOLD_TEST_DATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    return get_session("tests", cores=4, shuffle_partitions=4, memory="4g")


@pytest.fixture(scope="session")
def data():
    return DATA


@pytest.fixture(scope="session")
def duck(data):
    import duckdb

    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for f in os.listdir(data):
        db.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{data}/{f}'")
    return db
