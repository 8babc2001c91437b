import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ratingloom.session import local_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(8, shuffle_partitions=4)
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoint")))
    yield session
    session.stop()


@pytest.fixture
def split_everything(spark):
    """Treat every key with more than three rows as too large for one task."""
    name = "spark.ratingloom.skew.minRows"
    spark.conf.set(name, "3")
    yield
    spark.conf.unset(name)
