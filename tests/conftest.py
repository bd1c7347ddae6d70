from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from fumeline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
           "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "6g",
           "spark.sql.maxMetadataStringLength": "2000"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def features(spark):
    """Line features from (group, paths) pairs, a path being a list of (x, y)."""
    from fumeline.sources.features import PATHS_TYPE

    def make(rows):
        data = [
            (g, [[(float(x), float(y)) for x, y in path] for path in paths]) for g, paths in rows
        ]
        return spark.createDataFrame(data, f"g string, paths {PATHS_TYPE}")

    return make
