import os
import sys
import time
from pathlib import Path

import pytest

os.environ["TZ"] = "UTC"
time.tzset()
sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from touchtrail import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "tests",
        master="local[4]",
        conf={
            "spark.sql.shuffle.partitions": 4,
            "spark.driver.memory": "4g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def in_zone(spark):
    """Run a test body under another session zone."""

    def use(zone):
        spark.conf.set("spark.sql.session.timeZone", zone)

    yield use
    spark.conf.set("spark.sql.session.timeZone", "UTC")
