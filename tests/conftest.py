import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stockout.session import build_session  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", 4, app_name="stockout-tests",
                            warehouse_dir=tempfile.mkdtemp(prefix="stockout-wh-"))
    yield session
    session.stop()
