import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from creditlens.session import local_session

    session = local_session(cores=4, memory="6g", app="tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from creditlens.plans.fixtures import Tables

    return Tables(spark, SMALL)
