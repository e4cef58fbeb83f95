"""Every registered query against its SQL counterpart."""

from __future__ import annotations

import duckdb
import pytest

from checks import REGISTRY
from tools.compare_with_duckdb import compare


@pytest.fixture(scope="module")
def db(folder):
    from pathlib import Path

    connection = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        connection.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query_agrees_with_sql(spark, db, folder, name):
    assert compare(spark, db, folder, name) == []


def test_entry_runs(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 1
    assert set(entry.oracle_sql()) <= set(entry.queries())
