import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from baobab.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="baobab-test-ckpt-")
    session = build_session(
        "local[4]",
        app_name="baobab-tests",
        shuffle_partitions=4,
        extra_conf={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g"},
    )
    yield session
    session.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="baobab-test-")
