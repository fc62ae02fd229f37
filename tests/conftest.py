import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from cartographer.session import ensure_checkpoint_dir, get_spark
    s = get_spark("local[4]", 4, extra={"spark.driver.memory": "8g"})
    ensure_checkpoint_dir(s)
    yield s
    s.stop()
