"""Exact quantiles in bounded memory.

Spark's exact ``percentile`` keeps every distinct value of a column in one buffer. Here a column with
few distinct values is counted by value, and a column with many is narrowed first: a sketch gives a
bracket that holds the wanted ranks, the rows below it are only counted, and the step is repeated
inside the bracket until few distinct values are left. Those are counted by value, and the value at
each rank is read off. A value that fills a third of the rows is one counted row throughout.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from quillframe.functions.types import as_number

BRACKET_VALUES = 50_000
SKETCH_ACCURACY = 10_000


@dataclass
class _Bracket:
    """Ranks ``first`` and ``last`` (from 0) of a column, known to lie among its values in ``[low, high]``."""

    column: str
    first: int
    last: int
    share: float
    low: float
    high: float
    below: int
    inside: int
    distinct: int
    slack: float = 2.0 / SKETCH_ACCURACY

    def holds(self, below: int, inside: int) -> bool:
        return below <= self.first and self.last < below + inside


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    bracket_values: int = BRACKET_VALUES,
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of the present values, per column; ``None`` where there is no value.

    Only counts and single values reach the driver: a constant number per column and probability.
    """
    names = list(dict.fromkeys(columns))
    if not names:
        return {}
    numbers = df.select(*[as_number(df, name).alias(f"v{i}") for i, name in enumerate(names)])
    value = {name: F.col(f"v{i}") for i, name in enumerate(names)}
    brackets = _whole_ranges(numbers, value, probabilities)
    wide = [b for b in brackets if b.distinct > bracket_values and b.low < b.high]
    while wide:
        _narrow(numbers, value, wide)
        wide = [b for b in wide if b.distinct > bracket_values and b.low < b.high]
    found = _values_at_ranks(numbers, value, brackets)
    result: dict[str, list[float | None]] = {name: [] for name in names}
    for bracket, (low, high) in zip(brackets, found):
        exact = low if low == high else low + (high - low) * bracket.share
        result[bracket.column].append(exact)
    return {name: values or [None] * len(probabilities) for name, values in result.items()}


def _whole_ranges(
    numbers: DataFrame, value: dict[str, Column], probabilities: Sequence[float]
) -> list[_Bracket]:
    summary = numbers.agg(
        *[
            F.struct(
                F.count(v).alias("n"),
                F.approx_count_distinct(v).alias("distinct"),
                F.min(v).alias("low"),
                F.max(v).alias("high"),
            ).alias(f"s{i}")
            for i, v in enumerate(value.values())
        ]
    ).first()
    brackets = []
    for name, seen in zip(value, summary):
        for probability in probabilities if seen["n"] else ():
            place = probability * (seen["n"] - 1)
            first = math.floor(place)
            brackets.append(
                _Bracket(
                    name, first, math.ceil(place), place - first,
                    seen["low"], seen["high"], 0, seen["n"], seen["distinct"],
                )
            )
    return brackets


def _inside(v: Column, bracket: _Bracket) -> Column:
    return v.between(F.lit(bracket.low), F.lit(bracket.high))


def _narrow(numbers: DataFrame, value: dict[str, Column], wide: list[_Bracket]) -> None:
    """One narrowing step for every wide bracket: two aggregations over the rows, no shuffle of values."""
    cuts = numbers.agg(
        *[
            F.percentile_approx(
                F.when(_inside(value[b.column], b), value[b.column]),
                [
                    max(0.0, (b.first - b.below) / b.inside - b.slack),
                    min(1.0, (b.last - b.below + 1) / b.inside + b.slack),
                ],
                SKETCH_ACCURACY,
            ).alias(f"q{i}")
            for i, b in enumerate(wide)
        ]
    ).first()
    tries = []
    for bracket, (low, high) in zip(wide, cuts):
        from_start = (bracket.first - bracket.below) / bracket.inside - bracket.slack <= 0
        to_end = (bracket.last - bracket.below + 1) / bracket.inside + bracket.slack >= 1
        tries.append((bracket.low if from_start else low, bracket.high if to_end else high))
    counts = numbers.agg(
        *[
            F.struct(
                F.count_if(value[b.column] < F.lit(low)).alias("below"),
                F.count_if(value[b.column].between(F.lit(low), F.lit(high))).alias("inside"),
                F.approx_count_distinct(
                    F.when(value[b.column].between(F.lit(low), F.lit(high)), value[b.column])
                ).alias("distinct"),
            ).alias(f"c{i}")
            for i, (b, (low, high)) in enumerate(zip(wide, tries))
        ]
    ).first()
    for bracket, (low, high), seen in zip(wide, tries, counts):
        if bracket.holds(seen["below"], seen["inside"]):
            if (low, high) == (bracket.low, bracket.high):
                bracket.distinct = 0  # cannot be narrowed further: count its values as they are
                continue
            bracket.low, bracket.high = low, high
            bracket.below, bracket.inside, bracket.distinct = seen["below"], seen["inside"], seen["distinct"]
        else:
            bracket.slack *= 4


def _values_at_ranks(
    numbers: DataFrame, value: dict[str, Column], brackets: list[_Bracket]
) -> list[tuple[float, float]]:
    if not brackets:
        return []
    ranges = list(dict.fromkeys((b.column, b.low, b.high) for b in brackets))
    cells = [
        F.when(value[c].between(F.lit(low), F.lit(high)), F.struct(F.lit(i).alias("range"), value[c].alias("value")))
        for i, (c, low, high) in enumerate(ranges)
    ]
    counted = (
        numbers.select(F.inline(F.array_compact(F.array(*cells))))
        .groupBy("range", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    running = counted.withColumn("upto", F.sum("n").over(Window.partitionBy("range").orderBy("value")))
    reads = []
    for i, b in enumerate(brackets):
        mine = F.col("range") == ranges.index((b.column, b.low, b.high))
        for rank in (b.first, b.last):
            reads.append(F.min(F.when(mine & (F.col("upto") > rank - b.below), F.col("value"))).alias(f"r{len(reads)}"))
    row = running.agg(*reads).first()
    return [(row[2 * i], row[2 * i + 1]) for i in range(len(brackets))]
