"""Run the registered queries and their SQL on the same tables and report every difference.

    python tools/compare_with_duckdb.py [folder] [name ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402

from checks import REGISTRY  # noqa: E402
from quillframe.session import local_session  # noqa: E402

# Spark types and the DuckDB types that hold the same values.
SAME_TYPES = {
    "bigint": {"BIGINT"}, "int": {"INTEGER"}, "double": {"DOUBLE"}, "string": {"VARCHAR"}, "boolean": {"BOOLEAN"},
    "timestamp_ntz": {"TIMESTAMP"}, "date": {"DATE"},
}


def ordered(rows, columns):
    """Rows with columns by name, sorted by their text."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(row[i] for i in order) for row in rows], key=repr)


def compare(spark, db, folder: str, name: str) -> list[str]:
    run, sql = REGISTRY[name]
    result = run(spark, folder)
    rows = [tuple(row) for row in result.collect()]
    if sql is None:
        return [] if rows else ["no rows"]
    expected = db.sql(sql)
    problems = []
    if sorted(result.columns) != sorted(expected.columns):
        return [f"columns {sorted(result.columns)} against {sorted(expected.columns)}"]
    kinds = dict(zip(expected.columns, [str(t) for t in expected.types]))
    for column, kind in result.dtypes:
        if kinds[column] not in SAME_TYPES.get(kind, {kinds[column]}):
            problems.append(f"{column}: {kind} against {kinds[column]}")
    theirs = expected.fetchall()
    mine, theirs = ordered(rows, result.columns), ordered(theirs, expected.columns)
    if len(mine) != len(theirs):
        problems.append(f"{len(mine)} rows against {len(theirs)}")
    else:
        unequal = [(a, b) for a, b in zip(mine, theirs) if a != b]
        if unequal:
            problems.append(f"{len(unequal)} of {len(mine)} rows differ, such as {unequal[0]}")
    if not rows:
        problems.append("no rows")
    return problems


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(REGISTRY)
    spark = local_session("compare", 8)
    db = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        db.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    bad = 0
    for name in names:
        started = time.perf_counter()
        try:
            problems = compare(spark, db, folder, name)
        except Exception as problem:  # noqa: BLE001 - the report goes on with the next query
            problems = [f"{type(problem).__name__}: {str(problem)[:600]}"]
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok':4} {time.perf_counter() - started:6.2f}s {name}", *problems, sep="\n       " if problems else " ", flush=True)
    print(f"{len(names) - bad} of {len(names)} queries agree")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
