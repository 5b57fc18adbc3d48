import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

# oracle parity runs here; set CARELAKE_TEST_SF=/root/testdata/sf0.01 for the driver's scale
SF_SMALL = os.environ.get("CARELAKE_TEST_SF", "/root/testdata/sf0.001")
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from carelake.plans.session import build_session
    s = build_session("local[*]", "carelake-tests", {"spark.sql.shuffle.partitions": "8"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck_small():
    from carelake.plans.compare import duck_connection
    from carelake.sources.tables import DRIVER_TABLES
    return duck_connection(SF_SMALL, DRIVER_TABLES)
