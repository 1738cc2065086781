import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
TESTS = ROOT / "tests"
sys.path[:0] = [str(ROOT), str(TESTS)]
# Python workers import the package and the fake API from here.
os.environ["PYTHONPATH"] = os.pathsep.join([str(ROOT), str(TESTS), os.environ.get("PYTHONPATH", "")])

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from lakesync.session import local_session

    warehouse = tmp_path_factory.mktemp("warehouse")
    session = local_session(8, "tests", spark__sql__warehouse__dir=str(warehouse))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def store(spark, tmp_path):
    from lakesync.plans.publish import SnapshotStore

    return SnapshotStore(spark, str(tmp_path / "store"))


def rows(df):
    """Rows as sorted tuples; NULLs sort first."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is not None, str(v)) for v in r])
