"""Literals that take the type of the column they are compared with or written to."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, SparkSession, functions as F, types as T

from quillframe.errors import TableError
from quillframe.functions.types import FLOATING, is_moment, is_number


def typed_literal(kind: T.DataType, value: Any, name: str) -> Column:
    """``value`` as a literal of the column type.

    Floating columns take the number as it is. Whole-number and truth-value columns take it cut off
    toward zero, so ``2.5`` acts as ``2``. All other columns take its text form. A NULL literal has
    the column's type.
    """
    if value is None:
        return F.lit(None).cast(kind)
    if is_number(kind):
        try:
            number = float(value)
            whole = value if isinstance(value, int) else int(number)
        except (TypeError, ValueError, OverflowError) as problem:
            raise TableError(f"Column '{name}' holds numbers, so it cannot be matched with {value!r}.") from problem
        if isinstance(kind, FLOATING):
            return F.lit(number)
        if isinstance(kind, T.DecimalType):
            return F.lit(number).cast(kind)
        return F.lit(int(whole))
    if is_moment(kind):
        found = F.lit(str(value)).try_cast(kind)
        if SparkSession.active().range(1).select(found.isNull()).first()[0]:
            raise TableError(f"Column '{name}' holds dates or times, and {value!r} is none.")
        return found
    return F.lit(str(value))
