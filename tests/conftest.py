import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from patloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = local_session(
        "4",
        "4g",
        **{"spark.checkpoint.dir": str(folder / "shared"), "spark.sql.warehouse.dir": str(folder / "warehouse")},
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables():
    return "/root/testdata/sf0.001"
