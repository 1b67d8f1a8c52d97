import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from logwarden.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    # a session zone with daylight saving: no result may depend on it
    session = local_session(
        4,
        **{
            "spark.sql.session.timeZone": "America/New_York",
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def log_file(tmp_path):
    def write(*lines, name="auth.log", newline="\n"):
        path = tmp_path / name
        path.write_bytes(b"".join(x if isinstance(x, bytes) else (x + newline).encode() for x in lines))
        return str(path)

    return write
