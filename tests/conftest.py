import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from arenaspark.session import build_session

    s = build_session("local[4]", shuffle_partitions=4, app_name="arenaspark-tests")
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted list of tuples of the chosen columns (all when none given)."""
    cols = cols or tuple(df.columns)
    data = [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
    return sorted(data, key=lambda t: tuple((v is None, 0 if v is None else v) for v in t))
