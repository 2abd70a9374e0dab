import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ripplet.session import get_session
    s = get_session("local[4]", 8, extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="ripplet-test-ckpt-")})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def bars(spark):
    from ripplet.sources.bars import daily_bars_from_lineitem
    return daily_bars_from_lineitem(spark, SF_SMALL).cache()
