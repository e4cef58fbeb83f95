"""Choosing, dropping and renaming columns; dropping rows that cannot be used."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from quillframe.errors import TableError
from quillframe.functions.names import known
from quillframe.functions.types import quoted


def select_columns(df: DataFrame, columns: Sequence[str], target: str | None = None) -> DataFrame:
    """The listed columns that exist. The target is always kept and needs at least one feature beside it."""
    chosen = known(df, columns)
    if target is not None:
        if target not in df.columns:
            raise TableError(f"There is no target column '{target}'.")
        if target not in chosen:
            chosen.append(target)
        if len(chosen) < 2:
            raise TableError("Keep at least one column besides the target.")
    if not chosen:
        raise TableError("None of the listed columns exists.")
    return df.select(*[quoted(name) for name in chosen])


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Without the listed columns; names that do not exist are ignored."""
    return df.drop(*known(df, columns))


def rename_map(df: DataFrame, mapping: Mapping[str, str]) -> dict[str, str]:
    """The part of a rename request that applies: existing columns with a non-blank new name, trimmed."""
    return {old: str(new).strip() for old, new in mapping.items() if old in df.columns and str(new).strip()}


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """All renames at once, so names can be swapped. A name that would occur twice is an error."""
    applied = rename_map(df, mapping)
    names = [applied.get(name, name) for name in df.columns]
    repeated = sorted({name for name in names if [other.lower() for other in names].count(name.lower()) > 1})
    if repeated:
        raise TableError(f"After renaming, these names would occur more than once: {', '.join(repeated)}.")
    return df.toDF(*names)


def rows_with_target(df: DataFrame, target: str) -> DataFrame:
    return df.where(quoted(target).isNotNull())


def rows_with_any_feature(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return df.dropna(how="all", subset=list(features))
