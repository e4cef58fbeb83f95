"""One value-frequency table for many columns.

Every cell becomes a row ``(column, ordinal, whole, real, exact, label, moment, instant)`` in which one typed slot
holds the value, and equal rows are counted. All columns share one scan and one shuffle. Spark counts
inside each task first, so a value that fills a third of the table reaches the shuffle as one row per
task. The slots keep each type's own order, which ``mode`` needs to break ties.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from quillframe.functions.sizing import broadcast_if_small, settle
from quillframe.functions.types import FLOATING, WHOLE, data_type, is_moment, quoted, refuse_nested

SLOTS = {
    "whole": "bigint", "real": "double", "exact": "decimal(38,18)", "label": "string", "moment": "timestamp_ntz", "instant": "timestamp",
}


LONG_TEXT = 64
_MARK = "\u0000sha256:"


def slot_of(kind: T.DataType) -> str:
    if isinstance(kind, (*WHOLE, T.BooleanType)):
        return "whole"
    if isinstance(kind, FLOATING):
        return "real"
    if isinstance(kind, T.DecimalType):
        # a decimal with more digits before or behind the point than the slot keeps its text
        return "exact" if kind.scale <= 18 and kind.precision - kind.scale <= 20 else "label"
    if isinstance(kind, T.TimestampType):
        return "instant"
    return "moment" if is_moment(kind) else "label"


def _cell(df: DataFrame, name: str) -> Column:
    kind = data_type(df, name)
    value = _counted_by(name) if isinstance(kind, T.StringType) else quoted(name)
    used = slot_of(kind)
    slots = [
        (value.cast(sql_type) if slot == used else F.lit(None).cast(sql_type)).alias(slot)
        for slot, sql_type in SLOTS.items()
    ]
    return F.struct(
        F.lit(name).alias("column"),
        F.lit(df.columns.index(name)).alias("ordinal"),
        value.isNotNull().alias("present"),
        *slots,
    )


def value_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``column, ordinal, present``, the slots, ``text`` and ``n``: one row per column and distinct value.

    Missing cells are counted in one row per column with ``present`` false. ``label`` and ``text`` of a long text are its beginning
    and digest; :func:`most_frequent` puts the texts back.
    """
    refuse_nested(df)
    names = list(columns if columns is not None else df.columns)
    cells = df.select(F.explode(F.array(*[_cell(df, name) for name in names])).alias("cell")).select("cell.*")
    keys = ["column", "ordinal", "present", *SLOTS]
    counted = cells.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(*keys, _text(df, names).alias("text"), "n")


def _text(df: DataFrame, names: list[str]) -> Column:
    """The text form of the filled slot, as the column's own type would be written."""
    kinds = {name: data_type(df, name).typeName() for name in names}
    days = [name for name, kind in kinds.items() if kind == "date"]
    truths = [name for name, kind in kinds.items() if kind == "boolean"]
    whole, moment = F.col("whole").cast("string"), F.col("moment").cast("string")
    if truths:
        whole = F.when(F.col("column").isin(truths), (F.col("whole") == 1).cast("string")).otherwise(whole)
    if days:
        moment = F.when(F.col("column").isin(days), F.col("moment").cast("date").cast("string")).otherwise(moment)
    # A decimal is written with the digits of its own column.
    exact = F.col("exact").cast("string")
    for name in names:
        kind = data_type(df, name)
        if slot_of(kind) == "exact":
            exact = F.when(F.col("column") == name, F.col("exact").cast(kind).cast("string")).otherwise(exact)
    return F.coalesce("label", whole, moment, F.col("instant").cast("string"), F.col("real").cast("string"), exact)


def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False) -> DataFrame:
    """``column, ordinal, distinct`` without missing values. The approximate form needs no shuffle of the values."""
    names = list(columns if columns is not None else df.columns)
    if approximate:
        sketches = df.agg(*[F.approx_count_distinct(quoted(name)).alias(f"c{i}") for i, name in enumerate(names)])
        rows = [
            F.struct(
                F.lit(name).alias("column"),
                F.lit(df.columns.index(name)).alias("ordinal"),
                F.col(f"c{i}").alias("distinct"),
            )
            for i, name in enumerate(names)
        ]
        return sketches.select(F.inline(F.array(*rows)))
    return (
        value_counts(df, names)
        .groupBy("column", "ordinal")
        .agg(F.count_if("present").alias("distinct"))
    )


def top_values(counts: DataFrame, k: int) -> DataFrame:
    """The ``k`` most frequent values of each column, ties by value.

    Spark limits each task to its own ``k`` best rows per column before the shuffle, so a column with
    billions of distinct values does not land in one task.
    """
    # Missing cells are ranked last instead of filtered first. A filter on `present` would move below the
    # counting and make it differ from the counting for other figures, which Spark then could not share.
    order = Window.partitionBy("column").orderBy(F.desc("present"), F.desc("n"), *SLOTS)
    ranked = counts.withColumn("place", F.row_number().over(order))
    return ranked.where((F.col("place") <= k) & F.col("present"))


def column_facts(counts: DataFrame) -> DataFrame:
    """``column, ordinal, rows, missing, distinct`` for every column of a frequency table."""
    return counts.groupBy("column", "ordinal").agg(
        F.sum("n").alias("rows"),
        F.coalesce(F.sum(F.when(~F.col("present"), F.col("n"))), F.lit(0)).alias("missing"),
        F.count_if("present").alias("distinct"),
    )


def facts_and_top(df: DataFrame, columns: Sequence[str], k: int) -> DataFrame:
    """:func:`column_facts` with ``top``, the ``k`` most frequent values as ``(place, text, n)``.

    Both sides of the join read the same counted table, whose shuffle Spark runs once.
    """
    counts = value_counts(df, columns)
    facts, top = column_facts(counts), top_values(counts, k)
    long = _long_columns(df, columns)
    if long:
        kind = F.col("column").isNotNull()
        both = settle(facts.withColumn("is_fact", kind).unionByName(_contenders(counts, k).withColumn("is_fact", ~kind), allowMissingColumns=True))
        facts, top = both.where("is_fact").select(*facts.columns), _resolved(df, both.where("NOT is_fact"), long, k)
    entry = F.struct("place", F.col("text").alias("value"), "n")
    return facts.join(top.groupBy("column").agg(F.array_sort(F.collect_list(entry)).alias("top")), "column", "left")


def most_frequent(df: DataFrame, columns: Sequence[str], k: int) -> DataFrame:
    """``column, place, n, text`` and the slots of the ``k`` most frequent values of each column, ties by value."""
    counts, long = value_counts(df, columns), _long_columns(df, columns)
    return _resolved(df, settle(_contenders(counts, k)), long, k) if long else top_values(counts, k)


def _long_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """The columns with texts that are counted by digest, from one aggregation without a shuffle of values."""
    names = [name for name in columns if isinstance(data_type(df, name), T.StringType)]
    if not names:
        return []
    seen = df.agg(*[F.max(_is_long(name)).alias(f"c{i}") for i, name in enumerate(names)]).first()
    return [name for name, long in zip(names, seen) if long]


def _is_long(name: str) -> Column:
    return (F.length(quoted(name)) > LONG_TEXT) | quoted(name).contains(_MARK)


def _counted_by(name: str) -> Column:
    digest = F.concat(F.substring(quoted(name), 1, LONG_TEXT), F.lit(_MARK), F.sha2(quoted(name), 256))
    return F.when(_is_long(name), digest).otherwise(quoted(name))


def _contenders(counts: DataFrame, k: int) -> DataFrame:
    """All values that may be among the ``k`` most frequent: long texts that begin alike and are equally frequent share a place."""
    begins = [F.substring(slot, 1, LONG_TEXT) if slot == "label" else F.col(slot) for slot in SLOTS]
    order = Window.partitionBy("column").orderBy(F.desc("present"), F.desc("n"), *begins)
    ranked = counts.withColumn("place", F.rank().over(order))
    return ranked.where((F.col("place") <= k) & F.col("present"))


def _resolved(df: DataFrame, contenders: DataFrame, long: Sequence[str], k: int) -> DataFrame:
    """The ``k`` most frequent values among settled contenders, with whole texts in ``label`` and ``text``."""
    wanted = settle(contenders.where(F.col("label").contains(_MARK)).select(F.col("column").alias("c"), F.col("label").alias("l")))
    cells = df.select(F.inline(F.array(*[F.struct(F.lit(n).alias("column"), F.when(_is_long(n), _counted_by(n)).alias("label"), quoted(n).alias("full_text")) for n in long])))
    held = cells.where("label IS NOT NULL").join(broadcast_if_small(wanted), (F.col("column") == F.col("c")) & (F.col("label") == F.col("l")))
    texts = settle(held.groupBy("column", "label").agg(F.any_value("full_text").alias("full_text")))
    whole = contenders.join(broadcast_if_small(texts), ["column", "label"], "left")
    kept = {"label": F.coalesce("full_text", "label"), "text": F.coalesce("full_text", "text")}
    found = whole.select(*[kept[c].alias(c) if c in kept else c for c in ("column", "ordinal", "present", *SLOTS, "text", "n")])
    return top_values(found, k)


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, n`` and the typed slots of each column's most frequent value, ties to the smallest.

    Columns without any value are absent.
    """
    return most_frequent(df, columns, 1).select("column", "n", *SLOTS)


def slot_literal(kind: T.DataType, row) -> Column:
    """The value of a collected frequency row as a literal of the column's type."""
    value = row[slot_of(kind)]
    if slot_of(kind) == "instant":
        return F.lit(value)
    if is_moment(kind):
        return F.lit(value.isoformat(sep=" ")).cast(kind)
    if isinstance(kind, T.BooleanType):
        return F.lit(bool(value))
    return F.lit(value).cast(kind)
