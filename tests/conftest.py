import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from flowlens.session import local_session

    s = local_session(cores=4, app="flowlens-tests", shuffle_partitions=4)
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted list of tuples (all columns if none given)."""
    sel = df.select(*cols) if cols else df
    return sorted(tuple(r) for r in sel.collect())
