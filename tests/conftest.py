import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallywood.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[4]",
        spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def text_file(tmp_path):
    """Write lines, ended as given, to a new file and return its path."""
    def write(name, lines, end="\n", last=True):
        path = tmp_path / name
        path.write_bytes((end.join(lines) + (end if last else "")).encode("utf-8"))
        return str(path)
    return write


def rows(df):
    return [tuple(r) for r in df.collect()]
