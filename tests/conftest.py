import pathlib
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tools"))

from given_tables import TESTDATA


@pytest.fixture(scope="session")
def spark():
    from dealgauge.session import build_session

    session = build_session(master="local[8]", shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def given(spark):
    from dealgauge.plans.workspace import workspace

    return workspace(spark, TESTDATA)
