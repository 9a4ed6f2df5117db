from __future__ import annotations

import contextlib
import io
import os
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if REPO not in sys.path:
    sys.path.insert(0, REPO)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from marketlake.session import checkpoint_root, clear_scratch, configure

    s = (
        SparkSession.builder.master("local[*]")
        .appName("marketlake-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    configure(s)
    checkpoint_root(s)
    yield s
    clear_scratch(s)
    s.stop()


@pytest.fixture()
def tmp_root(spark):
    from marketlake.session import scratch_dir

    return scratch_dir(spark, "test")


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()
