import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from ledgerloom.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 4, shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    folder = "/root/testdata/sf0.01"
    if not Path(folder).exists():
        pytest.skip("test tables are not here")
    return folder
