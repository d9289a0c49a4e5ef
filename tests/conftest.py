import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from corpuslens.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("4", partitions=4)
