"""Row hashes that stay the same for the same key and seed, whatever the partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from quillframe.functions.types import quoted

_DIGITS = 15


def seeded_hash(keys: Sequence[str], seed: int) -> Column:
    """The hex digits of ``md5("<key>:...:<seed>")``. As they are all of one length, their order as text is that of the numbers.

    MD5 rather than Spark's own hash functions, so that any SQL engine can repeat the draw.
    """
    parts = [F.coalesce(quoted(key).cast("string"), F.lit("")) for key in keys]
    return F.md5(F.concat_ws(":", *parts, F.lit(str(seed))))


def share_of_hashes(pct: int) -> str:
    """The text below which ``pct`` percent of all hashes lie."""
    return f"{pct * 16**_DIGITS // 100:0{_DIGITS}x}"


def row_digest(df: DataFrame) -> Column:
    """A 256-bit digest of the whole row, for which NULL differs from every text.

    Each value is written as its length and text, so neighbouring values cannot run together.
    """
    parts = []
    for field in df.schema.fields:
        value = quoted(field.name)
        if field.dataType.typeName() in ("double", "float"):
            value = value + F.lit(0.0)  # -0.0 and 0.0 are one value
        text = value.cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("~")))
    return F.unhex(F.sha2(F.concat_ws(",", *parts), 256))
