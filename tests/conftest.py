import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from rejoinder.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[8]", "tests",
        **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "8g", "spark.log.level": "ERROR"},
    )
    yield session
    session.stop()
