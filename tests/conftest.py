import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from lexflume.session import session

    s = session("local[4]", "lexflume-tests", spark__sql__shuffle__partitions="4", spark__driver__memory="4g", spark__checkpoint__dir=f"file://{tmp_path_factory.mktemp('checkpoint')}", spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")))
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
