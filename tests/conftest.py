import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from tabflow.session import local_session, shared_dir

    s = local_session("*", shuffle_partitions=8, app="tabflow-tests")
    shared_dir(s)  # sets a checkpoint folder only where the session has none
    yield s
    s.stop()


@pytest.fixture
def root(tmp_path):
    """Staging root for a test (a cluster uses the shared checkpoint folder)."""
    return str(tmp_path / "shared")
