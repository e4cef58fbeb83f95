"""Row conditions in which a missing value satisfies ``!=`` and fails every other comparison.

``field("Score") > 2`` describes a comparison; ``&`` and ``|`` combine comparisons. Literals take the
column's type (see :func:`quillframe.functions.literals.typed_literal`). A condition is bound to a
table in two ways. :meth:`Condition.on` gives a column that is true or false, never NULL.
:meth:`Condition.filter_on` leaves a failed comparison NULL, which a filter drops as well: there is no
negation, so NULL and false lead to the same rows, and only the bare comparison is pushed into the scan.
"""

from __future__ import annotations

import operator
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from quillframe.errors import TableError
from quillframe.functions.literals import typed_literal
from quillframe.functions.types import data_type, quoted


@dataclass(frozen=True, eq=False)
class Condition:
    filter_on: Callable[[DataFrame], Column]

    def on(self, df: DataFrame) -> Column:
        return F.coalesce(self.filter_on(df), F.lit(False))

    def __and__(self, other: Condition) -> Condition:
        return Condition(lambda df: self.filter_on(df) & other.filter_on(df))

    def __or__(self, other: Condition) -> Condition:
        return Condition(lambda df: self.filter_on(df) | other.filter_on(df))


EVERY_ROW = Condition(lambda df: F.lit(True))


@dataclass(frozen=True, eq=False)
class Field:
    name: str

    def __eq__(self, value: Any) -> Condition:  # type: ignore[override]
        if value is None:
            return Condition(lambda df: self._column(df).isNull())
        return self._ordered(operator.eq, value)

    def __ne__(self, value: Any) -> Condition:  # type: ignore[override]
        if value is None:
            return Condition(lambda df: self._column(df).isNotNull())
        return Condition(lambda df: ~self._column(df).eqNullSafe(self._literal(df, value)))

    def __lt__(self, value: Any) -> Condition:
        return self._ordered(operator.lt, value)

    def __le__(self, value: Any) -> Condition:
        return self._ordered(operator.le, value)

    def __gt__(self, value: Any) -> Condition:
        return self._ordered(operator.gt, value)

    def __ge__(self, value: Any) -> Condition:
        return self._ordered(operator.ge, value)

    def _ordered(self, compare: Callable[[Any, Any], Any], value: Any) -> Condition:
        if value is None:
            raise TableError("NULL can only be compared with == or !=.")
        return Condition(lambda df: compare(self._column(df), self._literal(df, value)))

    def _column(self, df: DataFrame) -> Column:
        if self.name not in df.columns:
            raise TableError(f"There is no column '{self.name}' to compare.")
        column = quoted(self.name)
        return column.cast("int") if data_type(df, self.name).typeName() == "boolean" else column

    def _literal(self, df: DataFrame, value: Any) -> Column:
        return typed_literal(data_type(df, self.name), value, self.name)


def field(name: str) -> Field:
    return Field(name)


def keep_rows(df: DataFrame, condition: Condition = EVERY_ROW) -> DataFrame:
    return df.where(condition.filter_on(df))
