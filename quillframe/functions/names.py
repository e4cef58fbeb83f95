"""Column-name rules."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame


def plain_name(name: str) -> str:
    """Lower case with every run of other characters turned into one underscore: ``" Unit-Price "`` -> ``unit_price``."""
    return "_".join(re.findall(r"[a-z0-9]+", name.lower()))


def clean_headers(raw: Iterable[str | None]) -> list[str]:
    """Trimmed, non-blank, distinct column names.

    A blank header becomes ``column_<position>``; the n-th repeat of a name gets the suffix ``_<n>``.
    Names that differ only in case count as repeats, because Spark resolves names without regard to
    case, and a suffix that is already taken moves on to the next free number.
    """
    trimmed = [(name or "").strip() or f"column_{place}" for place, name in enumerate(raw, start=1)]
    taken = {name.lower() for name in trimmed}
    uses: dict[str, int] = {}
    names: list[str] = []
    for name in trimmed:
        count = uses.get(name.lower(), 0) + 1
        chosen = name
        if count > 1:
            chosen = f"{name}_{count}"
            while chosen.lower() in taken:
                count += 1
                chosen = f"{name}_{count}"
            taken.add(chosen.lower())
        uses[name.lower()] = count
        names.append(chosen)
    return names


def with_clean_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*clean_headers(df.columns))


def known(df: DataFrame, names: Iterable[str]) -> list[str]:
    """The listed names that exist, in the listed order, without repeats."""
    present = set(df.columns)
    return [name for name in dict.fromkeys(names) if name in present]
