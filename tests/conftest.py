import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from changeflow.session import build_session  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", 8, **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF
