import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from loadgauge.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "local[8]", "loadgauge-tests", **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))}
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL
