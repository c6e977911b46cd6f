import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from acctrecon.plans.cut import ensure_checkpoint_dir  # noqa: E402
from acctrecon.plans.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", "acctrecon-tests", shuffle_partitions=4, driver_memory="4g")
    ensure_checkpoint_dir(s, tempfile.mkdtemp(prefix="acctrecon-test-ckpt-"))
    yield s
    s.stop()
