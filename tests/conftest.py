import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from lakesmith.session import local_session, scratch_root

    s = local_session(shuffle_partitions=8)
    scratch_root(s)
    yield s


@pytest.fixture(scope="session")
def entry():
    import __spark_entry__ as E

    return E


@pytest.fixture(scope="session")
def duck_small():
    from tests.oracle_compare import duck_connection

    return duck_connection(SF_SMALL)
