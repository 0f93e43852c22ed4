import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    import tempfile

    from tidewire.session import build_session
    warehouse = tempfile.mkdtemp(prefix="tidewire-warehouse-")  # keep tables out of the repo
    s = build_session(master="local[*]", shuffle_partitions=8, app="tidewire-tests",
                      extra={"spark.sql.warehouse.dir": warehouse})
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    """A fresh directory below the session's checkpoint directory."""
    from tidewire.session import scratch_path
    return scratch_path(spark, "test")


def local_path(p: str) -> str:
    return p[len("file:"):] if p.startswith("file:") else p
