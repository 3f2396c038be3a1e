import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ.setdefault("PYSPARK_PYTHON", sys.executable)

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from corpusloom.session import session

    s = session("tests", **{"spark.master": "local[4]", "spark.driver.memory": "4g", "spark.sql.shuffle.partitions": "4"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def data():
    if not os.path.isdir(DATA):
        pytest.skip("the test tables aren't here")
    return DATA
