import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from postlake.session import local_session
    s = local_session("4", shuffle_partitions=8, app_name="postlake-tests",
                      warehouse_dir=tempfile.mkdtemp(prefix="postlake-test-wh-"))
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="postlake-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_table(tmp_path):
    return str(tmp_path / "table")


def rows(df, *cols):
    """Sorted list of tuples (order-insensitive comparison helper)."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
