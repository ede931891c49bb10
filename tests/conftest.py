import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from courtside.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[4]", shuffle_partitions=4,
                      extra={"spark.driver.memory": "4g", "spark.sql.adaptive.enabled": "true"})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="courtside-test-")


def rows(df, *cols):
    """Collected rows as sorted tuples (optionally of selected columns)."""
    d = df.select(*cols) if cols else df
    return sorted(tuple(r) for r in d.collect())
