import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_TINY = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tierwell.session import local_session
    s = local_session("*", shuffle_partitions=8, app="tierwell-tests")
    yield s


@pytest.fixture(scope="session")
def wh(spark):
    from tierwell.plans.warehouse import Warehouse
    return Warehouse(spark, SF_TINY)


def rows(df, *cols):
    cols = cols or df.columns
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
