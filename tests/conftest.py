import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from compare import duck, session  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    return session(os.environ.get("TEST_CPUS", "8"), "8g", str(tmp_path_factory.mktemp("checkpoints")))


@pytest.fixture(scope="session")
def con():
    return duck(SF)


@pytest.fixture(scope="session")
def sf_dir():
    return SF
