import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from lakekit.session import get_spark, workdir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return get_spark("tests", cores=8, shuffle=4)


@pytest.fixture
def new_dir(spark):
    """Names of unused folders."""
    return lambda label="t": workdir(spark, label)


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
