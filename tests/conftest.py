"""Shared Spark session: local, several shuffle partitions so real shuffles happen."""

from __future__ import annotations

import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    session = (
        SparkSession.builder.master("local[4]")
        .appName("strata-tests")
        .config("spark.sql.shuffle.partitions", os.environ.get("STRATA_TEST_PARTITIONS", "8"))
        .config("spark.default.parallelism", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    from strata.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(session, tempfile.mkdtemp(prefix="strata-ckpt-"))
    yield session
    session.stop()


@pytest.fixture()
def scratch(tmp_path):
    """A fresh folder per test (tests may run in any order)."""
    return str(tmp_path)
