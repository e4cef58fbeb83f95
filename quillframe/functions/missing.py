"""Missing values: one notion, SQL NULL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quillframe.functions.types import FLOATING, quoted

# The texts that count as missing when a delimited file is read.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def fold_tokens(column: Column) -> Column:
    """NULL where the text is a missing-value token, the text itself elsewhere."""
    return F.when(~column.isin(*MISSING_TOKENS), column)


def fold_missing_tokens(df: DataFrame) -> DataFrame:
    """Apply :func:`fold_tokens` to every text column."""
    texts = {field.name for field in df.schema.fields if field.dataType.typeName() == "string"}
    return df.select(
        *[fold_tokens(quoted(name)).alias(name) if name in texts else quoted(name) for name in df.columns]
    )


def fold_nan(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL, so that Spark's NaN does not pass for a value. No-op without floating columns."""
    floating = {field.name for field in df.schema.fields if isinstance(field.dataType, FLOATING)}
    if not floating:
        return df
    return df.select(
        *[
            F.when(~F.isnan(quoted(name)), quoted(name)).alias(name) if name in floating else quoted(name)
            for name in df.columns
        ]
    )
