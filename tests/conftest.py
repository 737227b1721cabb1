import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from loadcast.session import build_session, ensure_checkpoint_root

    s = build_session(
        "loadcast-tests", master="local[*]", shuffle_partitions=8, conf={"spark.driver.memory": "4g"}
    )
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_root(s)
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    """A fresh folder below the checkpoint root for one test."""
    from loadcast.session import local_path, scratch_path

    return local_path(scratch_path(spark, "test"))
