"""The profile of a table: column summaries, a ranking of likely targets and the task they suggest."""

from __future__ import annotations

import time
from collections.abc import Sequence
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T

from quillframe.errors import TableError
from quillframe.functions.convert import DATE_FORMATS, to_datetime
from quillframe.functions.missing import fold_nan
from quillframe.functions.names import plain_name
from quillframe.functions.types import (
    as_number, category_columns, data_type, is_moment, is_number, number_columns, quoted, refuse_nested,
)
from quillframe.operators.frequency import column_facts, facts_and_top, most_frequent, value_counts
from quillframe.operators.quantiles import exact_quantiles
from quillframe.operators.reports import duplicate_rows
from quillframe.sources.tables import preview, require_content

# Words that mark a likely target, most telling first.
TARGET_WORDS = (
    "target", "label", "class", "outcome", "result", "response", "dependent",
    "price", "sales", "score", "churn", "species", "diagnosis", "status",
)
# Words that mark an identifier, and those that mark a date.
ID_WORDS = ("id", "uuid", "guid", "index", "serial", "code")
DATE_WORDS = ("date", "time", "year", "month")
# Points of the target ranking.
WHOLE_NAME, PART_OF_NAME, PART_OF_NAME_LOSS = 100, 55, 20
LAST_COLUMN, FEW_OUTCOMES, FEW_GAPS, MANY_GAPS = 15, 16, 6, -35
CONSTANT, NEARLY_UNIQUE, IDENTIFIER = -100, -28, -80
# Limits of the same rules.
OUTCOMES_AT_LEAST, GAPS_BELOW, GAPS_ABOVE, UNIQUE_ABOVE = 20, 0.05, 0.4, 0.95
HIGH_SCORE, HIGH_LEAD, MEDIUM_LEAD = 60, 35, 12
# Limits of task detection.
CLASSES_AT_LEAST, CLASSES_AT_MOST, CLASS_SHARE = 12, 50, 0.2
DATE_SHARE = 0.8  # fixed value: of the values of a column of dates this share must parse
# Entries kept.
TOP_VALUES, TOP_TARGETS, TOP_REASONS = 3, 8, 3


def numeric_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``column, ordinal, mean, std, min, median, max``, rounded to 4 places; the deviation of one value is 0."""
    names = [n for n in (columns if columns is not None else df.columns) if is_number(data_type(df, n))]
    if not names:
        return df.sparkSession.createDataFrame([], _NUMERIC)
    medians = exact_quantiles(df, names, [0.5])

    def summary(name: str) -> Column:
        x = as_number(df, name)
        deviation = F.when(F.count(x) > 0, F.coalesce(F.stddev_samp(x), F.lit(0.0)))
        figures = {
            "mean": F.avg(x), "std": deviation, "min": F.min(x), "median": F.lit(medians[name][0]).cast("double"), "max": F.max(x),
        }
        return F.struct(
            F.lit(name).alias("column"),
            F.lit(df.columns.index(name)).alias("ordinal"),
            *[F.round(figure, 4).alias(alias) for alias, figure in figures.items()],
        )

    return df.agg(F.array(*[summary(n) for n in names]).alias("rows")).select(F.inline("rows"))


_NUMERIC = "column string, ordinal int, mean double, std double, min double, median double, max double"


def top_texts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``column, place, value, n``: the three most frequent values of each non-numeric column, ties by value."""
    names = [n for n in (columns if columns is not None else category_columns(df))]
    return most_frequent(df, names, TOP_VALUES).select("column", "place", F.col("text").alias("value"), "n")


def datetime_columns(df: DataFrame, formats: Sequence[str] = DATE_FORMATS) -> list[str]:
    """Columns that hold dates: by type, or by name if most of their values parse.

    Whole numbers under a date-like name count as dates. All values of the columns with such a name are looked at, in
    one aggregation.
    """
    found = {f.name for f in df.schema.fields if is_moment(f.dataType)}
    kinds = {n: data_type(df, n) for n in df.columns if n not in found and any(word in plain_name(n) for word in DATE_WORDS)}
    named = [n for n, kind in kinds.items() if not isinstance(kind, T.BooleanType)]
    if named:
        parsed = [to_datetime(quoted(n), kinds[n], formats) if isinstance(kinds[n], T.StringType) else quoted(n) for n in named]
        seen = df.agg(*[F.try_divide(F.count(p), F.count(quoted(n))).alias(f"s{i}") for i, (n, p) in enumerate(zip(named, parsed))]).first()
        found |= {n for n, share in zip(named, seen) if share is not None and share >= DATE_SHARE}
    return [n for n in df.columns if n in found]


def _name_points(name: str) -> tuple[int, str | None]:
    """Points for a target word in the name, and the word. The first of the list that occurs decides, whole or in part."""
    plain = plain_name(name)
    word = next((w for w in TARGET_WORDS if w in plain), None)
    if word is None:
        return 0, None
    place = TARGET_WORDS.index(word)
    points = WHOLE_NAME - place if plain == word else PART_OF_NAME - min(place, PART_OF_NAME_LOSS)
    return points, f"named {word}"


def _is_identifier(name: str) -> bool:
    return plain_name(name).split("_")[-1] in ID_WORDS


def rank_targets(df: DataFrame, facts: DataFrame | None = None) -> DataFrame:
    """``column, ordinal, score, reasons``: how likely each column is the one to predict."""
    facts = facts if facts is not None else column_facts(value_counts(df))
    last = len(df.columns) - 1
    by_name = []
    for ordinal, name in enumerate(df.columns):
        points, reason = _name_points(name)
        by_name.append((name, points, reason, ordinal == last, _is_identifier(name)))
    rules = df.sparkSession.createDataFrame(
        by_name, "column string, name_points int, name_reason string, is_last boolean, is_id boolean"
    )
    rows = F.greatest(F.col("rows"), F.lit(1))
    distinct, gaps = F.col("distinct"), F.col("missing") / rows
    few = F.greatest(F.lit(OUTCOMES_AT_LEAST), F.floor(F.sqrt(rows)))
    rules_of_facts = {
        "last column": (F.col("is_last"), LAST_COLUMN), "few outcomes": (distinct.between(F.lit(2), few), FEW_OUTCOMES),
        "few gaps": (gaps < GAPS_BELOW, FEW_GAPS), "many gaps": (gaps > GAPS_ABOVE, MANY_GAPS), "constant": (distinct <= 1, CONSTANT),
        "nearly unique": (distinct / rows > UNIQUE_ABOVE, NEARLY_UNIQUE), "identifier": (F.col("is_id"), IDENTIFIER),
    }
    # A reason is the name of the rule and what it counts.
    score, reasons = F.col("name_points"), [F.concat(F.col("name_reason"), F.format_string(" (%+d)", "name_points"))]
    for rule, (holds, points) in rules_of_facts.items():
        score = score + F.when(holds, points).otherwise(0)
        reasons.append(F.when(holds, F.lit(f"{rule} ({points:+d})")))
    return facts.join(F.broadcast(rules), "column").select(  # one row per column name
        "column", "ordinal", F.round(score.cast("double"), 2).alias("score"), F.array_compact(F.array(*reasons)).alias("reasons")
    )


def best_targets(ranked: DataFrame, k: int = TOP_TARGETS) -> DataFrame:
    return ranked.orderBy(F.desc("score"), "ordinal").limit(k)


def choose_target(ranked: DataFrame) -> DataFrame:
    """One row: ``target, score, lead, confidence, reason``."""
    two = best_targets(ranked, 2).agg(
        F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("rank"), "ordinal", "column", "reasons"))).alias("top")
    )
    score = -F.element_at("top", 1)["rank"]
    second = F.try_element_at("top", F.lit(2))["rank"]
    lead = score + F.coalesce(second, F.lit(0.0))
    confidence = (
        F.when((score >= HIGH_SCORE) | (lead >= HIGH_LEAD), "high").when(lead >= MEDIUM_LEAD, "medium").otherwise("low")
    )
    reason = F.array_join(F.slice(F.element_at("top", 1)["reasons"], 1, TOP_REASONS), "; ")
    return two.select(
        F.element_at("top", 1)["column"].alias("target"),
        score.alias("score"),
        lead.alias("lead"),
        confidence.alias("confidence"),
        F.when(reason == "", "no rule holds").otherwise(reason).alias("reason"),
    )


def detect_task(df: DataFrame, target: str) -> DataFrame:
    """One row: ``target, present, distinct, task``: classification, regression or unknown."""
    if target not in df.columns:
        raise TableError(f"There is no column '{target}'.")
    values = df.where(quoted(target).isNotNull()).groupBy(quoted(target)).agg(F.count(F.lit(1)).alias("n"))
    counted = values.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("present"), F.count(F.lit(1)).alias("distinct"))
    task = _task(F.lit(is_number(data_type(df, target))), F.col("present"), F.col("distinct"))
    return counted.select(F.lit(target).alias("target"), "present", "distinct", task.alias("task"))


def _task(numeric: Column, present: Column, distinct: Column) -> Column:
    """The task that a target of this kind suggests: numbers are classes only if they are few and come again."""
    most = F.greatest(F.lit(CLASSES_AT_LEAST), F.least(F.lit(CLASSES_AT_MOST), F.floor(F.sqrt(present))))
    classes = ~numeric | ((distinct <= most) & (distinct <= CLASS_SHARE * present))
    return F.when(distinct < 2, "unknown").when(classes, "classification").otherwise("regression")


def usable_features(df: DataFrame) -> DataFrame:
    """:func:`feature_types` of the columns that have any value, with ``present``, the number of rows that have one."""
    present = df.agg(*[F.count(quoted(n)).alias(f"c{i}") for i, n in enumerate(df.columns)])
    rows = F.array(*[F.struct(F.lit(i).alias("ordinal"), F.col(f"c{i}").alias("present")) for i in range(len(df.columns))])
    counted = present.select(F.inline(rows)).where("present > 0")
    return counted.join(F.broadcast(feature_types(df)), "ordinal").select("column", "ordinal", "kind", "present")  # one row per column


def feature_types(df: DataFrame) -> DataFrame:
    """``column, ordinal, kind``: numeric or categorical."""
    numeric = set(number_columns(df))
    rows = [(n, i, "numeric" if n in numeric else "categorical") for i, n in enumerate(df.columns)]
    return df.sparkSession.createDataFrame(rows, "column string, ordinal int, kind string")


def column_profiles(df: DataFrame) -> DataFrame:
    """One row per column: type, missing, distinct, either numeric figures or top values, and the task it suggests as a target."""
    kinds = [(f.name, f.dataType.simpleString(), not is_number(f.dataType)) for f in df.schema.fields]
    types = df.sparkSession.createDataFrame(kinds, "column string, dtype string, is_text boolean")
    pct = F.round(F.col("missing") / F.greatest(F.col("rows"), F.lit(1)) * 100, 2)
    return (
        facts_and_top(df, df.columns, TOP_VALUES)
        .join(F.broadcast(types), "column")  # one row per column name
        .join(numeric_summary(df).drop("ordinal"), "column", "left")
        .select(
            "column", "ordinal", "dtype", "rows", "missing", pct.alias("missing_pct"), "distinct",
            "mean", "std", "min", "median", "max", F.when(F.col("is_text"), F.col("top")).alias("top_values"),
            _task(~F.col("is_text"), F.col("rows") - F.col("missing"), F.col("distinct")).alias("task"),
        )
        .orderBy("ordinal")
    )


def profile(
    df: DataFrame,
    name: str = "table",
    order_by: Sequence[str] = (),
    target: str | None = None,
    columns: Sequence[str] | None = None,
    date_column: str | None = None,
) -> dict[str, Any]:
    """The whole profile as one record; every figure covers the whole table.

    The table is read for the value frequencies (one shuffle for counts and top values of all columns),
    for the numeric figures and for the row digests. ``target``, ``columns`` and ``date_column`` override
    what was found. The record has a fixed number of entries per column, however many rows there are.
    """
    started = time.perf_counter()
    refuse_nested(df)
    spark = df.sparkSession
    df = require_content(fold_nan(df))
    found = [row.asDict(recursive=True) for row in column_profiles(df).collect()]
    facts = spark.createDataFrame(
        [(c["column"], c["ordinal"], c["rows"], c["missing"], c["distinct"]) for c in found],
        "column string, ordinal int, rows bigint, missing bigint, distinct bigint",
    )
    ranked = rank_targets(df, facts)
    best = [row.asDict() for row in best_targets(ranked).collect()]
    chosen = choose_target(ranked).first()
    rows, gaps = found[0]["rows"], sum(c["missing"] for c in found)
    cells = rows * len(df.columns)
    dates = datetime_columns(df)
    record = {
        "name": name,
        "rows": rows,
        "columns": len(df.columns),
        "cells": cells,
        "column_names": list(df.columns),
        "selected_columns": list(df.columns),
        "target": chosen["target"],
        "target_confidence": chosen["confidence"],
        "target_reason": chosen["reason"],
        "target_rankings": best,
        "datetime_columns": dates,
        "date_column": dates[0] if dates else None,
        "missing_cells": gaps,
        "missing_pct": round(gaps / max(1, cells) * 100, 2),
        "duplicate_rows": duplicate_rows(df).first()["duplicate_rows"],
        "column_profiles": found,
        "preview": [row.asDict() for row in preview(df, order_by).collect()],
        "created_at": datetime.now(timezone.utc).isoformat(timespec="seconds"),
    }
    record = override(df, record, target, columns, date_column)
    if "task" not in record:
        record["task"] = next(c["task"] for c in found if c["column"] == record["target"])
    record["profile_seconds"] = round(time.perf_counter() - started, 3)
    return record


def override(
    df: DataFrame,
    record: dict[str, Any],
    target: str | None = None,
    columns: Sequence[str] | None = None,
    date_column: str | None = None,
) -> dict[str, Any]:
    """A profile with the caller's own target, columns or date column; a new target gets its own task."""
    changed = dict(record)
    if target is not None:
        changed["task"] = detect_task(df, target).first()["task"]
        changed.update(target=target, target_confidence="manual", target_reason="chosen by the caller")
    if columns is not None:
        chosen = [c for c in dict.fromkeys(columns) if c in df.columns]
        if changed["target"] not in chosen:
            chosen.append(changed["target"])
        if len(chosen) < 2:
            raise TableError("Keep at least one column besides the target.")
        changed["selected_columns"] = chosen
    if date_column is not None:
        if date_column not in df.columns:
            raise TableError(f"There is no column '{date_column}'.")
        changed["date_column"] = date_column
    return changed
