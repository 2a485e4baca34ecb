import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from tracelake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tracelake-tests",
        master="local[8]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def no_broadcast(spark):
    """Make every measured side too big to broadcast."""
    spark.conf.set("spark.tracelake.broadcast.maxRows", "0")
    spark.conf.set("spark.tracelake.join.salts", "3")
    yield
    spark.conf.unset("spark.tracelake.broadcast.maxRows")
    spark.conf.unset("spark.tracelake.join.salts")
