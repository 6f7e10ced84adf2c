import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tiermart.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        master="local[8]",
        shuffle_partitions=4,
        conf={
            "spark.driver.memory": "4g",
            "spark.sql.session.timeZone": "UTC",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(autouse=True)
def look_at_small_tables(monkeypatch):
    """Hot keys are looked for in the small tables of the tests, too."""
    monkeypatch.setattr("tiermart.operators.skew.SMALLEST_TABLE", 0)


@pytest.fixture
def conf(spark):
    """Set session settings for one test."""
    before = {}

    def put(**settings):
        for name, value in settings.items():
            key = "spark.sql." + name.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, str(value))

    yield put
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)
