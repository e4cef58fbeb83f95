"""What several of these operators share: columns without clashes, bounded slices of Arrow batches, arrays of texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

SLICE_ROWS, SLICE_BYTES = 256, 2 << 20


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def column(df: DataFrame, name: str, kind: str | None = None) -> Column:
    """A column by its exact name, or NULL where the table lacks it."""
    if name in df.columns:
        found = df[f"`{name}`"]
        return found.cast(kind) if kind else found
    return F.lit(None).cast(kind or "string")


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", rows: int = SLICE_ROWS, size_limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in slices of few rows and, beyond one row, few bytes of text."""
    for batch in batches:
        lengths = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch[text]), 0), dtype=np.int64)
        start, size = 0, 0
        for i, length in enumerate(lengths.tolist()):
            if i > start and (size + length > size_limit or i - start >= rows):
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += length
        if start < len(lengths):
            yield batch.slice(start)
    pa.default_memory_pool().release_unused()  # a worker goes on to other tasks


def arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)
