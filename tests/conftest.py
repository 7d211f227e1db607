import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from carespark.session import local_session

    s = local_session(cores=4, shuffle_partitions=8, app="carespark-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def wh(spark):
    from carespark.plans.warehouse import Warehouse

    return Warehouse.from_driver(spark, SF_SMALL)
