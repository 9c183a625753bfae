import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from terraloom.session import local_session, prepare


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = prepare(local_session("*", "tests"))
    s.sparkContext.setLogLevel("ERROR")
    if s.sparkContext.getCheckpointDir() is None:
        s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    return s
