import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from starloom.session import local_session

    s = local_session(cores="*", shuffle_partitions=8, app="starloom-tests")
    yield s


@pytest.fixture(scope="session")
def duck():
    import duckdb

    def connect(sf_dir):
        con = duckdb.connect()
        con.execute("SET TimeZone='UTC'")
        for f in os.listdir(sf_dir):
            if f.endswith(".parquet"):
                con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{os.path.join(sf_dir, f)}')")
        return con

    return connect
