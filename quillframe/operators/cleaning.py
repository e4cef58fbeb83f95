"""Cleaning operators: ``DataFrame -> DataFrame``.

Operators that need a figure of the whole table (a mean, a quantile, a mode) work like the estimators
of ``pyspark.ml``: one bounded aggregation first, whose few numbers then stand as literals in a
narrow projection or filter. The result is a map-only plan, its filters reach the scan, and a chain
of such operators stays linear in size.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from quillframe.errors import TableError
from quillframe.functions.convert import DATE_FORMATS, converted
from quillframe.functions.literals import typed_literal
from quillframe.functions.names import known
from quillframe.functions.types import WHOLE, as_number, data_type, is_moment, is_number, quoted
from quillframe.operators.frequency import modes, slot_literal
from quillframe.operators.predicates import EVERY_ROW, Condition
from quillframe.operators.quantiles import exact_quantiles

FILL_METHODS = ("mean", "median", "mode", "constant")
SCALES = ("standard", "minmax")
_ABSENT = object()


def remove_missing(df: DataFrame, columns: Sequence[str] = ()) -> DataFrame:
    """Drop rows with a gap in any listed column; no known name listed means every column."""
    return df.dropna(how="any", subset=known(df, columns) or None)


def fill_missing(
    df: DataFrame, columns: Sequence[str] = (), method: str = "median", value: Any = _ABSENT
) -> DataFrame:
    """Fill gaps in the listed columns, or in all of them.

    ``mean`` and ``median`` apply to numbers, ``mode`` to everything; where they do not apply, the
    constant does. Without a ``value`` the constant is 0, False or ``Unknown`` by type; there is none for dates
    and times, whose gaps stay. A ``value`` that is no date is an error for them. A whole-number
    column becomes a double when its filling is not a whole number. Columns without gaps stay as they are.
    """
    if method not in FILL_METHODS:
        raise TableError(f"Unknown way to fill '{method}'; choose one of {', '.join(FILL_METHODS)}.")
    names = known(df, columns) or list(df.columns)
    fillings: dict[str, Column] = {}
    if method in ("mean", "median"):
        numbers = [n for n in names if is_number(data_type(df, n)) and not _is_boolean(df, n)]
        fillings = _averages(df, numbers, method)
        names = [n for n in names if n not in numbers] + list(fillings)
    elif method == "mode":
        names = _gapped(df, names)
        found = {row["column"]: row for row in modes(df, names).collect()} if names else {}
        fillings = {n: slot_literal(data_type(df, n), found[n]) for n in names if n in found}
    for name in names:
        if name not in fillings and not (value is _ABSENT and is_moment(data_type(df, name))):
            fillings[name] = _constant(df, name, value)
    return _replaced(df, {n: F.coalesce(quoted(n), filling) for n, filling in fillings.items()})


def _gapped(df: DataFrame, names: list[str]) -> list[str]:
    gaps = df.agg(*[F.count_if(quoted(n).isNull()).alias(f"g{i}") for i, n in enumerate(names)]).first()
    return [n for n, count in zip(names, gaps) if count]


def _averages(df: DataFrame, numbers: list[str], method: str) -> dict[str, Column]:
    """A filling for each column that has both gaps and values."""
    if not numbers:
        return {}
    seen = df.agg(
        *[
            F.struct(
                F.count_if(quoted(n).isNull()).alias("gaps"),
                (F.avg(quoted(n)) if method == "mean" else F.lit(None)).cast("double").alias("mean"),
            ).alias(f"s{i}")
            for i, n in enumerate(numbers)
        ]
    ).first()
    gapped = {n: s["mean"] for n, s in zip(numbers, seen) if s["gaps"]}
    if method == "median":
        gapped = {n: q[0] for n, q in exact_quantiles(df, list(gapped), [0.5]).items()}
    return {n: _number_filling(df, n, v) for n, v in gapped.items() if v is not None}


def _number_filling(df: DataFrame, name: str, number: float) -> Column:
    kind = data_type(df, name)
    if isinstance(kind, WHOLE) and float(number).is_integer():
        return F.lit(int(number)).cast(kind)
    return F.lit(float(number))


def _constant(df: DataFrame, name: str, value: Any) -> Column:
    kind = data_type(df, name)
    if _is_boolean(df, name):
        return F.lit(False) if value is _ABSENT else converted(F.lit(str(value)), T.StringType(), "boolean")
    if is_number(kind):
        try:
            return _number_filling(df, name, 0.0 if value is _ABSENT else float(value))
        except (TypeError, ValueError) as problem:
            raise TableError(f"Column '{name}' holds numbers, so it cannot be filled with {value!r}.") from problem
    return typed_literal(kind, "Unknown" if value is _ABSENT else value, name).cast(kind)


def remove_duplicates(df: DataFrame) -> DataFrame:
    """One of each distinct row. Copies collapse inside each task before the shuffle."""
    return df.dropDuplicates()


def replace_values(
    df: DataFrame, column: str, find: Any, replace: Any, condition: Condition = EVERY_ROW
) -> DataFrame:
    """Write ``replace`` where the whole value equals ``find`` and the row meets the condition."""
    kind = _kind_of(df, column)
    filling = typed_literal(kind, replace, column)
    filling = (filling != 0) if isinstance(kind, T.BooleanType) and replace is not None else filling.cast(kind)
    return _replaced(df, {column: F.when(_hit(df, column, find, condition), filling).otherwise(quoted(column))})


def _hit(df: DataFrame, column: str, find: Any, condition: Condition) -> Column:
    """The rows that a replacement touches; a missing ``find`` touches none."""
    if find is None:
        return F.lit(False)
    value = quoted(column).cast("int") if _is_boolean(df, column) else quoted(column)
    same = value == typed_literal(data_type(df, column), find, column)
    return F.coalesce(condition.on(df) & same, F.lit(False))


def remove_outliers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep values within 1.5 interquartile ranges of the quartiles, and gaps.

    The columns are taken one after the other: each one's quartiles are those of the rows that the
    columns before it left over.
    """
    names = [n for n in known(df, columns) if is_number(data_type(df, n))]
    truths = [n for n in names if _is_boolean(df, n)]
    if truths:
        raise TableError(f"Truth values have no outliers: {', '.join(truths)}.")
    for name in names:
        first, third = exact_quantiles(df, [name], [0.25, 0.75])[name]
        if first is None:
            continue
        reach = 1.5 * (third - first)
        value = quoted(name)
        df = df.where(value.isNull() | value.between(F.lit(first - reach), F.lit(third + reach)))
    return df


def normalize(df: DataFrame, columns: Sequence[str], method: str = "standard") -> DataFrame:
    """Scale numeric columns to mean 0 and sample deviation 1, or to the range 0 to 1 (``minmax``).

    A column without spread becomes 0 in every row, gaps included. A column with a single value has no
    sample deviation and becomes missing under ``standard``.
    """
    if method not in SCALES:
        raise TableError(f"Unknown scale '{method}'; choose one of {', '.join(SCALES)}.")
    names = [n for n in known(df, columns) if is_number(data_type(df, n))]
    if not names:
        return df
    centre, width = (F.avg, F.stddev_samp) if method == "standard" else (F.min, F.max)
    seen = df.agg(
        *[F.struct(centre(as_number(df, n)).alias("a"), width(as_number(df, n)).alias("b")) for n in names]
    ).first()
    scaled = {}
    for name, (start, end) in zip(names, seen):
        spread = end if method == "standard" or end is None else end - start
        if spread is None:
            scaled[name] = F.lit(None).cast("double")
        elif spread == 0:
            scaled[name] = F.lit(0.0)
        else:
            scaled[name] = (as_number(df, name) - F.lit(start)) / F.lit(spread)
    return _replaced(df, scaled)


def convert_type(df: DataFrame, column: str, dtype: str, formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    """Convert a column to integer, decimal, boolean, category, date, datetime or text; what does not parse is missing."""
    return _replaced(df, {column: converted(quoted(column), _kind_of(df, column), dtype, formats)})


def custom_clean(df: DataFrame, clean_data: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Apply a caller's own table function and check that it returns a table with rows to show."""
    result = clean_data(df)
    if not isinstance(result, DataFrame):
        raise TableError(f"The cleaning function must return a DataFrame, not {type(result).__name__}.")
    if not result.columns:
        raise TableError("The cleaning function returned a table without columns.")
    return result


def custom_clean_batches(
    df: DataFrame, clean_data: Callable[[pd.DataFrame], pd.DataFrame], schema: T.StructType | str
) -> DataFrame:
    """Apply a caller's pandas function to Arrow batches of the table.

    For functions that look at each row by itself: batches are arbitrary pieces of the table. The result must fit
    ``schema``.
    """

    def run(batches):
        for batch in batches:
            result = clean_data(batch)
            if not isinstance(result, pd.DataFrame):
                raise TypeError(f"The cleaning function must return a DataFrame, not {type(result).__name__}.")
            yield result

    return df.mapInPandas(run, schema)


def _kind_of(df: DataFrame, column: str) -> T.DataType:
    if column not in df.columns:
        raise TableError(f"There is no column '{column}'.")
    return data_type(df, column)


def _is_boolean(df: DataFrame, name: str) -> bool:
    return isinstance(data_type(df, name), T.BooleanType)


def _replaced(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """The table with some columns recomputed, in place and in one projection."""
    return df.select(*[columns[n].alias(n) if n in columns else quoted(n) for n in df.columns])


replacement_hit = _hit
