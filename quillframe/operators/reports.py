"""What an operator changed, and the state of a table, as small tables of their own.

Reports are separate from the operators, so cleaning stays lazy and nothing is counted unasked.
Figures of two tables meet as scalar subqueries in one row.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from quillframe.functions.convert import DATE_FORMATS, converted
from quillframe.functions.hashing import row_digest
from quillframe.functions.types import data_type, quoted
from quillframe.operators.cleaning import replacement_hit
from quillframe.operators.predicates import EVERY_ROW, Condition


def one_row(df: DataFrame, **figures: Column) -> DataFrame:
    return df.sparkSession.range(1).select(*[figure.alias(name) for name, figure in figures.items()])


def row_count(df: DataFrame) -> Column:
    """The number of rows as a scalar subquery."""
    return df.agg(F.count(F.lit(1)).alias("n")).scalar()


def removed_rows(before: DataFrame, after: DataFrame) -> DataFrame:
    """``rows_before, rows_after, rows_removed``."""
    counted = one_row(before, rows_before=row_count(before), rows_after=row_count(after))
    return counted.withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))


def replaced_values(df: DataFrame, column: str, find: Any, condition: Condition = EVERY_ROW) -> DataFrame:
    """``replaced``: how many values a replacement would touch."""
    return df.agg(F.count_if(replacement_hit(df, column, find, condition)).alias("replaced"))


def conversion_failures(df: DataFrame, column: str, dtype: str, formats=DATE_FORMATS) -> DataFrame:
    """``present_before, present_after, failed``: values that a conversion would turn into missing ones."""
    after = converted(quoted(column), data_type(df, column), dtype, formats)
    counted = df.agg(F.count(quoted(column)).alias("present_before"), F.count(after).alias("present_after"))
    return counted.withColumn("failed", F.greatest(F.col("present_before") - F.col("present_after"), F.lit(0)))


def missing_counts(df: DataFrame) -> DataFrame:
    """``column, ordinal, rows, missing, missing_pct`` for every column, from one aggregation."""
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(quoted(n).isNull()).alias(f"m{i}") for i, n in enumerate(df.columns)],
    )
    rows = [
        F.struct(
            F.lit(n).alias("column"),
            F.lit(i).alias("ordinal"),
            F.col("rows").alias("rows"),
            F.col(f"m{i}").alias("missing"),
            F.coalesce(F.round(F.try_divide(F.col(f"m{i}"), F.col("rows")) * 100, 2), F.lit(0.0)).alias("missing_pct"),
        )
        for i, n in enumerate(df.columns)
    ]
    return counts.select(F.inline(F.array(*rows)))


def missing_by_column(df: DataFrame) -> DataFrame:
    """``column, missing, bar``: missing cells per column, with the fullest bar at 100."""
    counts = df.agg(*[F.count_if(quoted(n).isNull()).alias(f"m{i}") for i, n in enumerate(df.columns)])
    places = range(len(df.columns))
    most = F.array_max(F.array(*[F.col(f"m{i}") for i in places], F.lit(1).cast("bigint")))
    rows = [
        F.struct(
            F.lit(n).alias("column"), F.col(f"m{i}").alias("missing"), (F.col(f"m{i}") / most * 100).alias("bar")
        )
        for i, n in zip(places, df.columns)
    ]
    return counts.select(F.inline(F.array(*rows)))


def missing_cells(df: DataFrame) -> DataFrame:
    """``rows, cells, missing_cells, missing_pct`` of the whole table."""
    gaps = sum((quoted(n).isNull().cast("bigint") for n in df.columns), F.lit(0).cast("bigint"))
    counted = df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(gaps), F.lit(0)).alias("missing_cells"))
    cells = F.col("rows") * len(df.columns)
    return counted.select(
        "rows",
        cells.alias("cells"),
        "missing_cells",
        F.round(F.col("missing_cells") / F.greatest(cells, F.lit(1)) * 100, 2).alias("missing_pct"),
    )


def shape(df: DataFrame) -> DataFrame:
    """``rows, columns, cells``."""
    width = len(df.columns)
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows", F.lit(width).cast("bigint").alias("columns"), (F.col("rows") * width).alias("cells")
    )


def duplicate_rows(df: DataFrame) -> DataFrame:
    """``rows, distinct_rows, duplicate_rows``.

    Rows are compared by their SHA-256 digest, so the shuffle carries 32 bytes per distinct row and task,
    however wide the table is.
    """
    digests = df.select(row_digest(df).alias("digest")).groupBy("digest").agg(F.count(F.lit(1)).alias("copies"))
    return digests.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("distinct_rows")
    ).withColumn("duplicate_rows", F.col("rows") - F.col("distinct_rows"))


def quality_scorecard(before: DataFrame, after: DataFrame) -> DataFrame:
    """``metric, percent, part, whole``: complete cells, unique rows, rows kept and columns kept."""
    width, former_width = len(after.columns), max(len(before.columns), 1)
    gaps = missing_cells(after).agg(F.first(F.struct("rows", "missing_cells"))).scalar()
    copies = duplicate_rows(after).agg(F.first("duplicate_rows")).scalar()
    figures = one_row(after, gaps=gaps, copies=copies, former=row_count(before)).select(
        F.col("gaps.rows").alias("rows"), F.col("gaps.missing_cells").alias("gaps"), "copies", "former"
    )
    rows, one = F.col("rows"), F.lit(1)
    cells = F.greatest(rows * width, one)

    def line(metric: str, percent: Column, part: Column, whole: Column) -> Column:
        return F.struct(
            F.lit(metric).alias("metric"),
            percent.cast("double").alias("percent"),
            part.cast("bigint").alias("part"),
            whole.cast("bigint").alias("whole"),
        )

    former = F.greatest(F.col("former"), one)
    lines = [
        line("complete_cells", (cells - F.col("gaps")) / cells * 100, cells - F.col("gaps"), cells),
        line(
            "unique_rows",
            F.when(rows > 0, (rows - F.col("copies")) / rows * 100).otherwise(100.0),
            rows - F.col("copies"),
            rows,
        ),
        line("rows_retained", F.least(F.lit(100.0), rows / former * 100), rows, F.col("former")),
        line("columns_retained", F.lit(min(100.0, width / former_width * 100)), F.lit(width), F.lit(former_width)),
    ]
    return figures.select(F.inline(F.array(*lines)))
