from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from marketlens.session import get_session

    s = get_session("local[4]", 4, app_name="marketlens-tests")
    yield s


@pytest.fixture(scope="session")
def tables(spark):
    """Converted test tables at the smallest scale factor (built once)."""
    from marketlens.sources.warehouse import tables_for

    return tables_for(spark, SF_SMALL)


@pytest.fixture()
def tmp_out(tmp_path):
    return str(tmp_path)
