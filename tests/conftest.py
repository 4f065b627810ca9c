import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from quarry.session import local_session
    s = local_session("*", shuffle_partitions=8, app="quarry-tests", memory="8g")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb
    from tools.check_oracle import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


SF_SMALL = "/root/testdata/sf0.001"
