import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from topicforge.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, app="topicforge-tests", shuffle_partitions=8)
    yield s
    s.stop()


def one(df, col=None):
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0] if col is None else rows[0][col]
