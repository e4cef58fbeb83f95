from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from quillframe.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("tests", 8, **{"spark.sql.shuffle.partitions": "4"})


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"


@pytest.fixture()
def gaps(spark):
    """Gaps in every column, one column without any value, one constant column with a gap."""
    rows = [
        (i, None if i % 3 == 0 else i * 1.5, None if i % 4 == 0 else i * 10, None if i % 5 == 0 else "ab"[i % 2], None if i % 2 else i > 5, None, None if i == 7 else 4.0)
        for i in range(12)
    ]
    return spark.createDataFrame(rows, "id long, n double, i long, s string, b boolean, empty double, same double")
