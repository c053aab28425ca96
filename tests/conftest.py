import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from depotkit.session import local_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    os.environ.setdefault("DEPOTKIT_DRIVER_MEMORY", "8g")
    return local_session(8, shuffle_partitions=4, app="tests")


@pytest.fixture(scope="session")
def folder():
    if not os.path.isdir(DATA):
        pytest.skip("driver tables not present")
    return DATA


def values(df, *columns, order=None):
    """Rows as tuples, in the order of the given column(s)."""
    rows = df.orderBy(*(order or columns[:1])).collect() if order or columns else df.collect()
    return [tuple(r[c] for c in columns) for r in rows]
