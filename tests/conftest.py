import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    """One local session for the suite; scratch and checkpoints go under the
    session's spark.checkpoint.dir (a private folder only when it is unset)."""
    from tickpulse.session import get_spark

    yield get_spark("local[4]", 8)
