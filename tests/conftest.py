"""Shared session and lake for the tests."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from delaylake.session import build_session

    work = tmp_path_factory.mktemp("spark")
    session = build_session(
        "delaylake-tests", "local[4]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="3g",
        spark__sql__warehouse__dir=str(work / "warehouse"),
        spark__sql__streaming__numRecentProgressUpdates="100",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def cfg(tmp_path):
    from delaylake.config import LakeConfig

    return LakeConfig(root=str(tmp_path / "lake"))


@pytest.fixture(scope="session")
def base(spark):
    """Delay events of the small test tables, every one with a route (as the feed gives)."""
    from pyspark.sql import functions as F

    from delaylake.contract import inputs

    rows = inputs.base(spark, SF).withColumn("route_id", F.coalesce("route_id", F.lit("UNKNOWN")))
    return rows.cache()


def rows(df, *cols):
    """Sorted rows for comparison."""
    chosen = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in chosen.collect()), key=repr)


def now():
    """The fixed present of the tests."""
    from pyspark.sql import functions as F

    return F.lit("2024-01-31 00:00:00").cast("timestamp")
