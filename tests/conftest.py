import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tickloom.session import build_session  # noqa: E402
from tickloom.sources.views import Views  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = build_session("tests", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g",
                      spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")), spark__ui__showConsoleProgress="false")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small(spark):
    return Views(spark, "/root/testdata/sf0.001")
