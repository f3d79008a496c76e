import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clickscope.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[*]", 8, app_name="clickscope-tests",
                  extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="clickscope-test-wh-")})
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        # tests only: the cluster names spark.checkpoint.dir itself
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="clickscope-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="clickscope-test-")


def rows(df, *cols):
    """Collected rows as sorted plain tuples (tests only, tiny inputs)."""
    cols = cols or tuple(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
