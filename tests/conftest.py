import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from daypulse.session import build_session, drop_work_folders  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session(**{"spark.master": "local[4]", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    if not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="daypulse-test-work-"))
    yield s
    drop_work_folders(s)


@pytest.fixture()
def tmp_root():
    return tempfile.mkdtemp(prefix="daypulse-test-")
