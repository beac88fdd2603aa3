import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def spark():
    from pulselake.session import session

    s = session("local[4]", 4, spark__driver__memory="4g", spark__ui__enabled="false")
    s.sparkContext.setLogLevel("ERROR")
    return s
