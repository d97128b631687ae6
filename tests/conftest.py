import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from feria.session import get_spark
    ckpt = tempfile.mkdtemp(prefix="feria-test-ckpt-")
    s = get_spark("local[4]", app="feria-tests", shuffle_partitions=4,
                  conf={"spark.checkpoint.dir": ckpt})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="feria-test-")


def rows(df):
    return [tuple(r) for r in df.collect()]
