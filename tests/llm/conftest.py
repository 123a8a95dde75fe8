import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parent)]

from caudal.llm.shared import prepare  # noqa: E402


@pytest.fixture
def session(spark):
    return prepare(spark)
