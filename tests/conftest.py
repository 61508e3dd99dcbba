from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from sparkdeck.session import ensure_checkpoint_dir  # noqa: E402

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (SparkSession.builder.master("local[*]").appName("sparkdeck-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    # the shared folder comes from spark.checkpoint.dir when the environment
    # names one; only when it is unset is a local folder created
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture
def lines(spark):
    """Build a ``value`` frame from Python strings."""
    def make(rows):
        return spark.createDataFrame([(r,) for r in rows], "value string")
    return make
