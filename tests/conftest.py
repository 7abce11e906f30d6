import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from eddyline.session import build_session
    s = build_session("local[4]", app="eddyline-tests", shuffle_partitions=8, conf={
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def lines_df(spark, values, partition=0):
    """Line frame from literal messages, seq in the given order."""
    rows = [(v, i, partition, None) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "value STRING, seq BIGINT, partition INT, timestamp TIMESTAMP")
