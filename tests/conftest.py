import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ledgerline.session import local_session

    session = local_session(partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL
