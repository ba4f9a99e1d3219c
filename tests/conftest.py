from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from farelake.session import build_session, shared_dir

    session = build_session("local[4]", shuffle_partitions=4)
    shared_dir(session)  # tests: a local folder registered as spark.checkpoint.dir
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small_dir():
    return SMALL
