import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from replyloom.session import local_session, shared_folder  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", 4, "replyloom-tests")
    session.sparkContext.setLogLevel("ERROR")
    shared_folder(session)
    yield session
    session.stop()
