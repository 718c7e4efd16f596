import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from barloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(4, partitions=4, memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


@pytest.fixture
def final_plan():
    """Text of the executed plan after AQE."""

    def run(df):
        df.collect()
        return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]

    return run
