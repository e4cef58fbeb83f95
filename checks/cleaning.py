"""Cleaning operators and their reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import (
    DATE_TEXT, DOUBLED, GAPPED, MIXED_TEXT, doubled_events, gapped_events, query, table, text_events,
)
from quillframe.operators import cleaning as C, reports as R
from quillframe.operators.predicates import field
from quillframe.plans.pipeline import run_steps

_REST = "event_id, ts, user_id, event_type"


@query(f"WITH {GAPPED} SELECT * FROM gapped WHERE user_id IS NOT NULL AND value IS NOT NULL")
def remove_missing_in_columns(spark, folder):
    return C.remove_missing(gapped_events(spark, folder), ["user_id", "value"])


@query(f"WITH {GAPPED} SELECT * FROM gapped WHERE user_id IS NOT NULL AND event_type IS NOT NULL AND value IS NOT NULL")
def remove_missing_anywhere(spark, folder):
    return C.remove_missing(gapped_events(spark, folder), ["nothing"])


@query(f"WITH {GAPPED} SELECT {_REST}, round(coalesce(value, (SELECT avg(value) FROM gapped)), 6) AS value FROM gapped")
def fill_with_mean(spark, folder):
    filled = C.fill_missing(gapped_events(spark, folder), ["value"], "mean")
    return filled.withColumn("value", F.round("value", 6))


@query(
    f"WITH {GAPPED} SELECT event_id, ts, coalesce(user_id, (SELECT quantile_cont(user_id::DOUBLE, 0.5) FROM gapped))::DOUBLE AS user_id, "
    "event_type, round(coalesce(value, (SELECT quantile_cont(value, 0.5) FROM gapped)), 6) AS value FROM gapped"
)
def fill_with_median(spark, folder):
    filled = C.fill_missing(gapped_events(spark, folder), ["value", "user_id"])
    return filled.withColumn("value", F.round("value", 6)).withColumn("user_id", F.col("user_id").cast("double"))


def _mode(column: str) -> str:
    return (
        f"coalesce({column}, (SELECT {column} FROM gapped WHERE {column} IS NOT NULL GROUP BY {column} "
        f"ORDER BY count(*) DESC, {column} LIMIT 1)) AS {column}"
    )


@query(f"WITH {GAPPED} SELECT event_id, ts, {_mode('user_id')}, {_mode('event_type')}, {_mode('value')} FROM gapped")
def fill_with_mode(spark, folder):
    return C.fill_missing(gapped_events(spark, folder), method="mode")


_LONG = "CASE WHEN doc_id % 5 = 0 THEN NULL ELSE concat(repeat('the same beginning ', 6), CAST(doc_id % 3 AS VARCHAR(2)), lang) END AS note"


@query(f"WITH gapped AS (SELECT doc_id, {_LONG} FROM documents) SELECT doc_id, {_mode('note')} FROM gapped")
def fill_long_texts_with_mode(spark, folder):
    return C.fill_missing(table(spark, folder, "documents").selectExpr("doc_id", _LONG), ["note"], method="mode")


# Gaps in columns of other types, and a tie between 9.00 and 10.00, of which the smaller number wins.
_TYPED = (
    "event_id", "CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 2 = 0 THEN CAST(9 AS DECIMAL(10, 2)) ELSE CAST(10 AS DECIMAL(10, 2)) END AS amount",
    "CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(ts AS DATE) END AS day", "CASE WHEN event_id % 11 = 0 THEN NULL ELSE ts END AS seen",
)
_TYPED_SQL = f"WITH gapped AS (SELECT {', '.join(_TYPED)} FROM events)"


@query(f"{_TYPED_SQL} SELECT event_id, CAST(a AS DOUBLE) AS amount, day, seen FROM (SELECT event_id, {_mode('amount').replace(' AS amount', ' AS a')}, {_mode('day')}, {_mode('seen')} FROM gapped)")
def fill_other_types_with_mode(spark, folder):
    filled = C.fill_missing(table(spark, folder, "events").selectExpr(*_TYPED), method="mode")
    return filled.withColumn("amount", F.col("amount").cast("double"))


@query(f"{_TYPED_SQL} SELECT event_id, coalesce(CAST(amount AS DOUBLE), 0) AS amount, day, seen FROM gapped")
def fill_other_types_with_default(spark, folder):
    """Dates and times have no default, so their gaps stay."""
    filled = C.fill_missing(table(spark, folder, "events").selectExpr(*_TYPED), method="constant")
    return filled.withColumn("amount", F.col("amount").cast("double"))


@query(f"{_TYPED_SQL} SELECT event_id, coalesce(day, DATE '2020-02-29') AS day FROM gapped")
def fill_dates_with_constant(spark, folder):
    filled = C.fill_missing(table(spark, folder, "events").selectExpr(*_TYPED), ["day"], "constant", "2020-02-29")
    return filled.select("event_id", "day")


@query(
    f"WITH {GAPPED} SELECT event_id, ts, coalesce(user_id, 0) AS user_id, coalesce(event_type, 'Unknown') AS event_type, "
    "coalesce(value, 0.0) AS value FROM gapped"
)
def fill_with_default(spark, folder):
    return C.fill_missing(gapped_events(spark, folder), method="constant")


@query(f"WITH {GAPPED} SELECT {_REST}, coalesce(value, -1.5) AS value FROM gapped")
def fill_with_constant(spark, folder):
    return C.fill_missing(gapped_events(spark, folder), ["value"], "constant", "-1.5")


@query(f"WITH {GAPPED} SELECT event_id, ts, user_id, coalesce(event_type, 'Unknown') AS event_type, value FROM gapped")
def fill_text_without_mean(spark, folder):
    """A mean does not apply to text, so the constant is used."""
    return C.fill_missing(gapped_events(spark, folder), ["event_type"], "mean")


@query(f"{DOUBLED} SELECT DISTINCT * FROM doubled")
def remove_duplicate_rows(spark, folder):
    return C.remove_duplicates(doubled_events(spark, folder))


@query(
    f"WITH {GAPPED} SELECT event_id, ts, user_id, CASE WHEN event_type = 'error' AND coalesce(value > 30, FALSE) THEN 'fault' "
    "ELSE event_type END AS event_type, value FROM gapped"
)
def replace_under_condition(spark, folder):
    return C.replace_values(gapped_events(spark, folder), "event_type", "error", "fault", field("value") > 30)


@query(f"WITH {GAPPED} SELECT event_id, CASE WHEN user_id = 7 THEN NULL ELSE user_id END AS user_id FROM gapped")
def replace_with_null(spark, folder):
    return C.replace_values(gapped_events(spark, folder), "user_id", "7.9", None).select("event_id", "user_id")


def _bounds(source: str, column: str) -> str:
    return (
        f"(SELECT quantile_cont({column}, 0.25) AS q1, quantile_cont({column}, 0.75) AS q3 FROM {source}) "
    )


_WITHIN = "BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)"


@query(f"WITH {GAPPED} SELECT gapped.* FROM gapped, {_bounds('gapped', 'value')} WHERE value IS NULL OR value {_WITHIN}")
def remove_outliers_one_column(spark, folder):
    return C.remove_outliers(gapped_events(spark, folder), ["value", "event_type"])


@query(
    "WITH d AS (SELECT doc_id, n_chars, (n_chars % 97)::DOUBLE * (n_chars % 97) * (n_chars % 97) AS score FROM documents), "
    f"first AS (SELECT d.* FROM d, {_bounds('d', 'n_chars')} WHERE n_chars {_WITHIN}) "
    f"SELECT first.* FROM first, {_bounds('first', 'score')} WHERE score {_WITHIN}"
)
def remove_outliers_in_turn(spark, folder):
    """The second column's quartiles are those of the rows that the first one left."""
    documents = table(spark, folder, "documents").selectExpr(
        "doc_id", "n_chars", "CAST(n_chars % 97 AS DOUBLE) * (n_chars % 97) * (n_chars % 97) AS score"
    )
    return C.remove_outliers(documents, ["n_chars", "score"])


@query(
    f"WITH {GAPPED}, s AS (SELECT avg(value) AS m, stddev_samp(value) AS d FROM gapped) "
    "SELECT event_id, round((value - m) / d, 6) AS value, 0.0::DOUBLE AS one FROM gapped, s"
)
def normalize_standard(spark, folder):
    """A constant column becomes 0 throughout, in its gaps too."""
    events = gapped_events(spark, folder).selectExpr(
        "event_id", "value", "CASE WHEN event_id % 3 = 0 THEN NULL ELSE 5 END AS one"
    )
    scaled = C.normalize(events, ["value", "one"])
    return scaled.withColumn("value", F.round("value", 6))


@query(
    f"WITH {GAPPED}, s AS (SELECT min(value) AS low, max(value) AS high FROM gapped) "
    "SELECT event_id, round((value - low) / (high - low), 6) AS value FROM gapped, s"
)
def normalize_minmax(spark, folder):
    scaled = C.normalize(gapped_events(spark, folder).select("event_id", "value"), ["value"], "minmax")
    return scaled.withColumn("value", F.round("value", 6))


_MIXED = f"WITH mixed AS (SELECT event_id, {MIXED_TEXT} FROM events)"


@query(f"{_MIXED} SELECT event_id, round_even(try_cast(trim(t) AS DOUBLE), 0)::BIGINT AS t FROM mixed")
def convert_to_integer(spark, folder):
    return C.convert_type(text_events(spark, folder, MIXED_TEXT), "t", "integer")


@query(f"{_MIXED} SELECT event_id, try_cast(trim(t) AS DOUBLE) AS t FROM mixed")
def convert_to_decimal(spark, folder):
    return C.convert_type(text_events(spark, folder, MIXED_TEXT), "t", "decimal")


@query(
    "WITH flags AS (SELECT event_id, CASE event_id % 8 WHEN 0 THEN ' TRUE' WHEN 1 THEN 'n' WHEN 2 THEN '1' WHEN 3 THEN 'No ' "
    "WHEN 4 THEN 't' WHEN 5 THEN '1.0' WHEN 6 THEN NULL ELSE event_type END AS t FROM events) "
    "SELECT event_id, CASE WHEN lower(trim(t)) IN ('true', '1', 'yes', 'y') THEN TRUE "
    "WHEN lower(trim(t)) IN ('false', '0', 'no', 'n') THEN FALSE END AS t FROM flags"
)
def convert_to_boolean(spark, folder):
    flags = text_events(
        spark, folder,
        "CASE event_id % 8 WHEN 0 THEN ' TRUE' WHEN 1 THEN 'n' WHEN 2 THEN '1' WHEN 3 THEN 'No ' "
        "WHEN 4 THEN 't' WHEN 5 THEN '1.0' WHEN 6 THEN NULL ELSE event_type END AS t",
    )
    return C.convert_type(flags, "t", "boolean")


@query(f"WITH {GAPPED} SELECT event_id, user_id::VARCHAR AS user_id FROM gapped")
def convert_to_category(spark, folder):
    return C.convert_type(gapped_events(spark, folder).select("event_id", "user_id"), "user_id", "category")


@query(f"WITH {GAPPED} SELECT event_id, user_id::VARCHAR AS user_id FROM gapped")
def convert_to_text(spark, folder):
    return C.convert_type(gapped_events(spark, folder).select("event_id", "user_id"), "user_id", "text")


_DATED = f"WITH dated AS (SELECT event_id, {DATE_TEXT} FROM events)"
_PARSED = "coalesce(try_cast(t AS TIMESTAMP), try_strptime(t, '%m/%d/%Y'))"


@query(f"{_DATED} SELECT event_id, {_PARSED} AS t FROM dated")
def convert_to_datetime(spark, folder):
    return C.convert_type(text_events(spark, folder, DATE_TEXT), "t", "datetime")


@query(f"{_DATED} SELECT event_id, CAST({_PARSED} AS DATE) AS t FROM dated")
def convert_to_date(spark, folder):
    return C.convert_type(text_events(spark, folder, DATE_TEXT), "t", "date")


@query(
    f"{_MIXED} SELECT count(t) AS present_before, count(try_cast(trim(t) AS DOUBLE)) AS present_after, "
    "count(t) - count(try_cast(trim(t) AS DOUBLE)) AS failed FROM mixed"
)
def conversion_failures(spark, folder):
    return R.conversion_failures(text_events(spark, folder, MIXED_TEXT), "t", "integer")


@query(
    f"{DOUBLED}, d AS (SELECT DISTINCT * FROM doubled) SELECT (SELECT count(*) FROM doubled) AS rows_before, "
    "(SELECT count(*) FROM d) AS rows_after, (SELECT count(*) FROM doubled) - (SELECT count(*) FROM d) AS rows_removed"
)
def removed_row_report(spark, folder):
    events = doubled_events(spark, folder)
    return R.removed_rows(events, C.remove_duplicates(events))


@query(f"WITH {GAPPED} SELECT count(*) AS replaced FROM gapped WHERE event_type = 'error' AND value > 30")
def replaced_value_report(spark, folder):
    return R.replaced_values(gapped_events(spark, folder), "event_type", "error", field("value") > 30)


@query(f"WITH {GAPPED} SELECT event_id, upper(event_type) AS event_type, value * 2 AS value FROM gapped WHERE value > 10")
def custom_table_function(spark, folder):
    def clean_data(df):
        return df.where("value > 10").selectExpr("event_id", "upper(event_type) AS event_type", "value * 2 AS value")

    return C.custom_clean(gapped_events(spark, folder), clean_data)


@query("SELECT o_orderkey, upper(o_orderstatus) || '!' AS mark, o_totalprice * 2 AS twice FROM orders WHERE o_totalprice > 1000")
def custom_batch_function(spark, folder):
    def clean_data(batch):
        kept = batch[batch["o_totalprice"] > 1000]
        return kept[["o_orderkey"]].assign(mark=kept["o_orderstatus"].str.upper() + "!", twice=kept["o_totalprice"] * 2)

    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return C.custom_clean_batches(orders, clean_data, "o_orderkey bigint, mark string, twice double")


@query(
    f"{DOUBLED}, d AS (SELECT DISTINCT * FROM doubled), "
    "f AS (SELECT event_id, event_type, coalesce(value, (SELECT quantile_cont(value, 0.5) FROM d)) AS value FROM d), "
    f"o AS (SELECT f.* FROM f, {_bounds('f', 'value')} WHERE value {_WITHIN}), "
    "r AS (SELECT event_id, CASE WHEN event_type = 'error' THEN 'fault' ELSE event_type END AS kind, value FROM o), "
    "s AS (SELECT avg(value) AS m, stddev_samp(value) AS d FROM r) "
    "SELECT event_id, kind, round((value - m) / d, 6) AS value FROM r, s"
)
def cleaning_steps(spark, folder):
    """A chain: duplicates, gaps, outliers, replacement, column names, scale."""
    steps = [
        ("remove_duplicates", {}),
        ("drop_columns", {"columns": ["ts", "user_id"]}),
        ("fill_missing", {"columns": ["value"], "method": "median"}),
        ("remove_outliers", {"columns": ["value"]}),
        ("replace", {"column": "event_type", "find": "error", "replace": "fault"}),
        ("rename_columns", {"mapping": {"event_type": "kind"}}),
        ("normalize", {"columns": ["value"]}),
        lambda df: df.withColumn("value", F.round("value", 6)),
    ]
    return run_steps(doubled_events(spark, folder), steps)


@query(
    f"{DOUBLED}, a AS (SELECT event_id, event_type, value FROM doubled WHERE user_id IS NOT NULL), "
    "f AS (SELECT count(*) AS n, sum((event_type IS NULL)::INT + (value IS NULL)::INT) AS gaps, "
    "(SELECT count(*) FROM (SELECT DISTINCT * FROM a)) AS d, (SELECT count(*) FROM doubled) AS before FROM a) "
    "SELECT 'complete_cells' AS metric, round((n * 3 - gaps)::DOUBLE / (n * 3) * 100, 6) AS percent, (n * 3 - gaps)::BIGINT AS part, (n * 3)::BIGINT AS whole FROM f "
    "UNION ALL SELECT 'unique_rows', round(d::DOUBLE / n * 100, 6), d, n FROM f "
    "UNION ALL SELECT 'rows_retained', round(n::DOUBLE / before * 100, 6), n, before FROM f "
    "UNION ALL SELECT 'columns_retained', 60.0, 3, 5"
)
def quality_scorecard(spark, folder):
    before = doubled_events(spark, folder)
    after = C.remove_missing(before, ["user_id"]).select("event_id", "event_type", "value")
    return R.quality_scorecard(before, after).withColumn("percent", F.round("percent", 6))


@query(
    f"WITH {GAPPED}, m AS (SELECT count(*) - count(user_id) AS u, count(*) - count(event_type) AS e, count(*) - count(value) AS v FROM gapped), "
    "r AS (SELECT 'event_id' AS \"column\", 0::BIGINT AS missing UNION ALL SELECT 'ts', 0 UNION ALL SELECT 'user_id', u FROM m "
    "UNION ALL SELECT 'event_type', e FROM m UNION ALL SELECT 'value', v FROM m) "
    "SELECT \"column\", missing, round(missing::DOUBLE / (SELECT max(missing) FROM r) * 100, 6) AS bar FROM r"
)
def missing_by_column(spark, folder):
    return R.missing_by_column(gapped_events(spark, folder)).withColumn("bar", F.round("bar", 6))
