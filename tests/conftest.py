import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tallyframe.plans.session import local_session

    scratch = tempfile.mkdtemp(prefix="tallyframe-tests-")
    s = local_session(cores=4, shuffle_partitions=4, app="tallyframe-tests",
                      checkpoint_dir=f"{scratch}/ckpt",
                      extra={"spark.sql.warehouse.dir": f"{scratch}/warehouse",
                             "spark.local.dir": f"{scratch}/local"})
    yield s
    s.stop()


@pytest.fixture()
def scratch_dir():
    return tempfile.mkdtemp(prefix="tallyframe-case-")


@pytest.fixture()
def own_settings(spark):
    """Sets session settings that are put back after the test."""
    before = {}

    def put(key: str, value: str) -> None:
        before.setdefault(key, spark.conf.get(key))
        spark.conf.set(key, value)

    yield put
    for key, value in before.items():
        spark.conf.set(key, value)
