"""Chains of cleaning steps."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from typing import Any

from pyspark.sql import DataFrame

from quillframe.errors import TableError
from quillframe.functions.missing import fold_nan
from quillframe.functions.sizing import store
from quillframe.functions.types import refuse_nested
from quillframe.operators import cleaning, projection

Step = tuple[str, dict[str, Any]] | Callable[[DataFrame], DataFrame]

OPERATIONS: dict[str, Callable[..., DataFrame]] = {
    "remove_missing": cleaning.remove_missing,
    "fill_missing": cleaning.fill_missing,
    "remove_duplicates": cleaning.remove_duplicates,
    "replace": cleaning.replace_values,
    "remove_outliers": cleaning.remove_outliers,
    "normalize": cleaning.normalize,
    "drop_columns": projection.drop_columns,
    "rename_columns": projection.rename_columns,
    "convert_type": cleaning.convert_type,
}

# Steps that look at each row by itself, so they need no figure of the table and work on streams too.
ROW_LOCAL = {"remove_missing", "replace", "drop_columns", "rename_columns", "convert_type"}
# Steps that read the table once or more to find their figures.
MEASURING = {"fill_missing", "remove_outliers", "normalize"}


def clean(df: DataFrame, operation: str, **options: Any) -> DataFrame:
    """One cleaning step by name."""
    if operation not in OPERATIONS:
        raise TableError(f"Unknown cleaning step '{operation}'; known steps are {', '.join(OPERATIONS)}.")
    return OPERATIONS[operation](df, **options)


def run_steps(df: DataFrame, steps: Iterable[Step]) -> DataFrame:
    """Apply the steps in order: names with options, or functions from table to table.

    A measuring step would make Spark repeat everything before it. Where that includes a shuffle or a
    caller's function, the table is first written below the checkpoint folder, once, and read from there.
    """
    refuse_nested(df)
    df = fold_nan(df)
    costly = False
    for step in steps:
        if callable(step):
            df, costly = cleaning.custom_clean(df, step), True
            continue
        operation, options = step
        if operation in MEASURING and costly:
            df, costly = store(df), False
        df = clean(df, operation, **options)
        costly = costly or operation == "remove_duplicates"
    return df
