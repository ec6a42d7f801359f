import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from inkwell.session import get_spark

    s = get_spark("tests", 4)
    s.sparkContext.setLogLevel("OFF")
    yield s
    s.stop()
