"""One local session for all tests."""

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
os.environ.setdefault("SPARK_LOCAL_IP", "127.0.0.1")

SF = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from weftline.runtime import session

    s = session("tests", "4", 4)
    s.sparkContext.setLogLevel("ERROR")
    return s


def rows(df):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
