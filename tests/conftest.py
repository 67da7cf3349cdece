import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from reachset.session import build_session

    s = build_session(master="local[*]", shuffle_partitions=8, app_name="reachset-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    d = "/root/testdata/sf0.001"
    for t in (
        "region nation customer supplier part orders lineitem events documents "
        "embeddings pages benchmark labels conversations"
    ).split():
        con.execute(f"create view {t} as select * from read_parquet('{d}/{t}.parquet')")
    return con
