import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from caudal.session import local_session  # noqa: E402
from caudal.sources.tables import Lake  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    checkpoints = str(tmp_path_factory.mktemp("checkpoints"))
    session = local_session(8, 2, memory="6g", app="caudal-tests",
                            extra={"spark.checkpoint.dir": checkpoints})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "lake"))
