"""One local session for all tests."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from trajecta.session import build, drop_scratch

    s = build("tests", "local[4]", 4)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    drop_scratch(s)
    s.stop()
