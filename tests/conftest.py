import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from kestrel.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    # tests own their checkpoint folder (the session has none configured)
    ck = tempfile.mkdtemp(prefix="kestrel-test-ckpt-")
    s = local_session(4, shuffle_partitions=8, app="kestrel-tests",
                      extra={"spark.checkpoint.dir": ck})
    yield s
    s.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="kestrel-test-")


def lines(spark, rows):
    """A ``value`` column of text lines, like ``spark.read.text``."""
    return spark.createDataFrame([(r,) for r in rows], "value string")
