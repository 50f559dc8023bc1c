import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))  # for Python workers

from shopfloor.session import local_session  # noqa: E402

DATA = os.environ.get("SHOPFLOOR_TEST_DATA", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    os.chdir(tmp_path_factory.mktemp("run"))  # saved tables land here
    yield local_session(cores=8, shared=str(tmp_path_factory.mktemp("shared")))


@pytest.fixture(scope="session")
def folder():
    return DATA


@pytest.fixture(scope="session")
def duck():
    from shopfloor.bindings import BASE_TABLES

    con = duckdb.connect()
    for t in BASE_TABLES:
        path = f"{DATA}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con
