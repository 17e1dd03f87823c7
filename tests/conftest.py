import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
os.environ.setdefault("PYARROW_IGNORE_TIMEZONE", "1")

from tillroll.session import build_session  # noqa: E402


def pytest_addoption(parser):
    parser.addoption(
        "--golden-dir",
        default=None,
        help="folder with the five canonical tables as CSV; enables the golden-result tests",
    )


def pytest_ignore_collect(collection_path, config):
    if collection_path.name == "test_golden.py" and not config.getoption("--golden-dir"):
        return True


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tillroll-tests",
        master="local[8]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
