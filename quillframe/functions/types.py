"""How Spark types fall into the few kinds the operators tell apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from quillframe.errors import TableError

WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FLOATING = (T.FloatType, T.DoubleType)
MOMENT = (T.DateType, T.TimestampType, T.TimestampNTZType)
NESTED = (T.ArrayType, T.MapType, T.StructType)


def data_type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def is_number(kind: T.DataType) -> bool:
    """Numbers for statistics, typing and literals; truth values count as numbers."""
    return isinstance(kind, (*WHOLE, *FLOATING, T.DecimalType, T.BooleanType))


def is_moment(kind: T.DataType) -> bool:
    return isinstance(kind, MOMENT)


def number_columns(df: DataFrame) -> list[str]:
    return [field.name for field in df.schema.fields if is_number(field.dataType)]


def category_columns(df: DataFrame) -> list[str]:
    return [field.name for field in df.schema.fields if not is_number(field.dataType)]


def family(kind: T.DataType) -> str:
    if isinstance(kind, T.BooleanType):
        return "truth value"
    if is_number(kind):
        return "number"
    if is_moment(kind):
        return "date"
    return "text"


def has_nested(df: DataFrame) -> bool:
    return any(isinstance(field.dataType, NESTED) for field in df.schema.fields)


def refuse_nested(df: DataFrame) -> None:
    """Arrays, maps and structs have no place in a flat table of features."""
    nested = [field.name for field in df.schema.fields if isinstance(field.dataType, NESTED)]
    if nested:
        raise TableError(f"Nested columns are not supported: {', '.join(nested)}. Select flat columns first.")


def quoted(name: str) -> Column:
    """A column by its exact name, even when the name holds a dot."""
    return F.col("`" + name.replace("`", "``") + "`")


def as_number(df: DataFrame, name: str) -> Column:
    """The column as a double; truth values become 0 and 1."""
    column = quoted(name)
    if isinstance(data_type(df, name), T.BooleanType):
        column = column.cast("int")
    return column.cast("double")
