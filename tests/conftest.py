import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))


@pytest.fixture(scope="session")
def spark():
    from foldwise.session import local_session

    session = local_session("*", os.environ.get("FOLDWISE_MEMORY", "8g"))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    from oracle import DATA

    return DATA
