import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from shelfmart.session import local_session
    s = local_session(cores="*", shuffle_partitions=8, app="shelfmart-tests")
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)


@pytest.fixture(scope="session")
def scratch():
    return tempfile.mkdtemp(prefix="shelfmart-test-")


def rows(df, order=None):
    """Collected rows as sorted tuples of plain values."""
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t)) if order is None else out
