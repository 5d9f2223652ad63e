import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]


@pytest.fixture(scope="session")
def spark():
    from millrace.session import session

    spark = session("tests", "local[8]", spark__sql__shuffle__partitions="8",
                    spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
                    spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def sf():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
