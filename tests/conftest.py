from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from casestar.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session("casestar-tests", "local[8]", **{
        "spark.driver.memory": "4g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def set_option(name: str, value: str) -> None:
        before.setdefault(name, spark.conf.get(name, None))
        spark.conf.set(name, value)

    yield set_option
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)
