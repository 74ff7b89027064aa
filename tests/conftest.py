import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from tallyloom.session import local, ship  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = local(cores=4, partitions=4, memory="4g")
    ship(s)
    yield s
    s.stop()
