from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from claimwright.session import DEFAULT_CONF, ensure_checkpoint_dir, release_scratch

    builder = SparkSession.builder.master("local[*]").appName("claimwright-tests")
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", "8")
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    if not session.sparkContext.getCheckpointDir() and not session.conf.get("spark.checkpoint.dir", None):
        # bare test session only: the cluster setting wins whenever present
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="claimwright-test-ckpt-"))
    ensure_checkpoint_dir(session)
    yield session
    release_scratch(session)
