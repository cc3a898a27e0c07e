import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from chargelens.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    # plans are searched for paths, which are cut at 100 characters otherwise
    session = local_session(8, spark__sql__shuffle__partitions=4, spark__sql__maxMetadataStringLength=1000)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF
