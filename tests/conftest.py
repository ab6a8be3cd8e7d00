import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from scriptloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cpus=4, shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_scripts(spark):
    def make(scripts: dict[str, str]):
        return spark.createDataFrame(list(scripts.items()), "script_id string, sql string")

    return make
