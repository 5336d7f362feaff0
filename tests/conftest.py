import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from candela.session import build_session
    s = build_session("local[4]", app="candela-tests", shuffle_partitions=4,
                      extra={"spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="candela-test-ckpt-"))
    yield s
    s.stop()


def bars_df(spark, rows, schema="ticker string, date date, close double"):
    return spark.createDataFrame(rows, schema)
