"""Cleaning steps on a stream.

Steps that look at each row by itself apply to a streaming table as they are. The others need a figure
of the whole table, which a stream does not have, and are refused.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import Any

from pyspark.sql import DataFrame

from quillframe.errors import TableError
from quillframe.plans.pipeline import ROW_LOCAL, clean


def clean_stream(stream: DataFrame, steps: Iterable[tuple[str, dict[str, Any]]]) -> DataFrame:
    """The streaming table with row-local cleaning steps applied, still a stream."""
    for operation, options in steps:
        constant = operation == "fill_missing" and options.get("method") == "constant"
        if operation not in ROW_LOCAL and not constant:
            raise TableError(f"The step '{operation}' needs the whole table and cannot run on a stream.")
        stream = clean(stream, operation, **options)
    return stream
