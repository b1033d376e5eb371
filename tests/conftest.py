import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from caseload.session import get_session
    s = get_session("local[4]", 4, extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="caseload-test-")})
    yield s
    s.stop()


@pytest.fixture()
def tmp(spark):
    from caseload.session import work_dir
    return work_dir(spark, "test")


def lines_df(spark, lines, path="mem"):
    return spark.createDataFrame([(v, path) for v in lines], "value string, file_path string")
