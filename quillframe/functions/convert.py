"""Type conversions that turn what does not parse into NULL instead of failing."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, functions as F, types as T

from quillframe.errors import TableError
from quillframe.functions.types import FLOATING, WHOLE, is_moment

# Texts that stand for true and false.
TRUE_TEXTS = ("true", "1", "yes", "y")
FALSE_TEXTS = ("false", "0", "no", "n")

# Tried in this order after ISO 8601; callers can pass their own list.
DATE_FORMATS = ("yyyy/MM/dd", "MM/dd/yyyy", "MM/dd/yyyy HH:mm:ss", "d MMM yyyy", "MMM d, yyyy")

_WHOLE_TEXT = r"^\s*[+-]?\d+\s*$"
_NUMBER_TEXT = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)\s*$"


def whole_text(text: Column) -> Column:
    """Text to bigint; NULL unless it is written as a whole number that fits."""
    return F.when(text.rlike(_WHOLE_TEXT), text.try_cast("bigint"))


def number_text(text: Column) -> Column:
    """Text to double; NULL unless it is written as a decimal number (``1d`` and ``0x10`` are not)."""
    return F.when(text.rlike(_NUMBER_TEXT), text.try_cast("double"))


def to_integer(column: Column, kind: T.DataType, _: Sequence[str]) -> Column:
    """Nearest whole number, halves to the even neighbour."""
    if isinstance(kind, (*WHOLE, T.BooleanType)):
        return column.cast("bigint")
    if isinstance(kind, T.StringType):
        return F.coalesce(whole_text(column), F.rint(number_text(column)).try_cast("bigint"))
    _refuse_moment(kind, "integer")
    return F.rint(column.cast("double")).try_cast("bigint")


def to_decimal(column: Column, kind: T.DataType, _: Sequence[str]) -> Column:
    """A double; NaN counts as missing."""
    if isinstance(kind, T.StringType):
        return number_text(column)
    _refuse_moment(kind, "decimal")
    if isinstance(kind, T.BooleanType):
        return column.cast("int").cast("double")
    number = column.cast("double")
    return F.when(~F.isnan(number), number) if isinstance(kind, FLOATING) else number


def to_boolean(column: Column, kind: T.DataType, _: Sequence[str]) -> Column:
    """True or false by the text form; ``1.0`` is neither."""
    text = F.lower(F.trim(column.cast("string")))
    return F.when(text.isin(*TRUE_TEXTS), F.lit(True)).when(text.isin(*FALSE_TEXTS), F.lit(False))


def to_text(column: Column, kind: T.DataType, _: Sequence[str]) -> Column:
    return column.cast("string")


def to_datetime(column: Column, kind: T.DataType, formats: Sequence[str]) -> Column:
    """A timestamp without time zone: ISO 8601 first, then each given format."""
    if isinstance(kind, T.StringType):
        return F.coalesce(
            column.try_cast("timestamp_ntz"),
            *[F.try_to_timestamp(F.trim(column), F.lit(pattern)).cast("timestamp_ntz") for pattern in formats],
        )
    _demand_moment(kind, "a date and time")
    return column.cast("timestamp_ntz")


def to_date(column: Column, kind: T.DataType, formats: Sequence[str]) -> Column:
    """The day of :func:`to_datetime`."""
    return to_datetime(column, kind, formats).cast("date")


CONVERSIONS: dict[str, Callable[[Column, T.DataType, Sequence[str]], Column]] = {
    "integer": to_integer,
    "decimal": to_decimal,
    "boolean": to_boolean,
    "category": to_text,
    "date": to_date,
    "datetime": to_datetime,
    "text": to_text,
}


def converted(column: Column, kind: T.DataType, target: str, formats: Sequence[str] = DATE_FORMATS) -> Column:
    if target not in CONVERSIONS:
        raise TableError(f"Unknown type '{target}'; known types are {', '.join(CONVERSIONS)}.")
    return CONVERSIONS[target](column, kind, formats)


def _refuse_moment(kind: T.DataType, target: str) -> None:
    if is_moment(kind):
        raise TableError(f"A date column cannot become {target}; convert it to text first.")


def _demand_moment(kind: T.DataType, target: str) -> None:
    if not is_moment(kind):
        raise TableError(f"A column of type {kind.simpleString()} cannot become {target}; convert it to text first.")
