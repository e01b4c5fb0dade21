import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from outagegrid.session import local_session

    session = local_session(4, shuffle_partitions=4, app="tests")
    if not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("rounds")))
    return session


@pytest.fixture(scope="session")
def data():
    folder = Path("/root/testdata/sf0.001")
    if not folder.exists():
        pytest.skip("benchmark tables are not here")
    return str(folder)
