from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from intactly.session import build_session
    session = build_session("local[4]", app="intactly-tests", shuffle_partitions=8,
                            extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="intactly-ckpt-")})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="intactly-test-")
