import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

DATA = os.path.join(ROOT, "tests", "data")
SAMPLE = os.path.join(DATA, "feed.csv")


@pytest.fixture(scope="session")
def spark():
    from tickreport.session import build_session
    s = build_session("local[*]", 8, app_name="tickreport-tests")
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
