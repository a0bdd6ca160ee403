import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from txpulse.session import build_session

    s = build_session(
        "local[4]",
        shuffle_partitions=4,
        extra={"spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "4"},
    )
    s.sparkContext.setLogLevel("ERROR")
    # tests own a private shared folder; a cluster names its own
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="txpulse-test-"))
    yield s
    s.stop()
