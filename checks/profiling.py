"""Profiles: figures per column and the choice of a target."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import DOUBLED, GAPPED, doubled_events, gapped_events, query, table
from quillframe.operators import reports as R
from quillframe.operators.frequency import distinct_counts
from quillframe.plans import profile as P

_COLUMNS = ("event_id", "ts", "user_id", "event_type", "value")


def _each(template: str, columns: tuple[str, ...] = _COLUMNS) -> str:
    return " UNION ALL ".join(template.format(name=name, place=place) for place, name in enumerate(columns))


@query(
    f"WITH {GAPPED} "
    + _each(
        "SELECT '{name}' AS \"column\", {place} AS ordinal, count(*) AS rows, count(*) - count({name}) AS missing, "
        "round((count(*) - count({name}))::DOUBLE / count(*) * 100, 2) AS missing_pct FROM gapped"
    )
)
def missing_per_column(spark, folder):
    return R.missing_counts(gapped_events(spark, folder))


@query(
    f"WITH {GAPPED} " + _each("SELECT '{name}' AS \"column\", {place} AS ordinal, count(DISTINCT {name}) AS \"distinct\" FROM gapped")
)
def distinct_per_column(spark, folder):
    return distinct_counts(gapped_events(spark, folder))


@query(_each("SELECT '{name}' AS \"column\", {place} AS ordinal, count(DISTINCT {name}) AS \"distinct\" FROM documents", ("doc_id", "text", "lang", "source", "n_chars")))
def distinct_in_documents(spark, folder):
    return distinct_counts(table(spark, folder, "documents"))


_SUMMARY = (
    "SELECT '{name}' AS \"column\", round(avg({name}), 4) AS mean, round(stddev_samp({name}), 4) AS std, "
    "round(min({name})::DOUBLE, 4) AS min, round(quantile_cont({name}::DOUBLE, 0.5), 4) AS median, round(max({name})::DOUBLE, 4) AS max FROM {source}"
)


@query(
    f"WITH {GAPPED} "
    + " UNION ALL ".join(_SUMMARY.format(name=name, source="gapped") for name in ("event_id", "user_id", "value"))
)
def numeric_figures(spark, folder):
    return P.numeric_summary(gapped_events(spark, folder)).drop("ordinal")


@query(
    " UNION ALL ".join(
        _SUMMARY.format(name=name, source="lineitem") for name in ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber")
    )
)
def numeric_figures_of_lineitem(spark, folder):
    lines = table(spark, folder, "lineitem")
    wanted = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]
    return P.numeric_summary(lines, wanted).drop("ordinal")


_TOP = (
    "SELECT '{name}' AS \"column\", place, value, n FROM (SELECT {name} AS value, count(*) AS n, "
    "row_number() OVER (ORDER BY count(*) DESC, {name})::INT AS place FROM {source} WHERE {name} IS NOT NULL GROUP BY {name}) WHERE place <= 3"
)


_BEGUN = "concat(repeat('one beginning of many texts ', 5), CAST({key} % 1000 AS VARCHAR(20)), text)"


@query(f"WITH d AS (SELECT text, {_BEGUN.format(key='doc_id')} AS begun FROM documents) " + _TOP.format(name="text", source="d") + " UNION ALL " + _TOP.format(name="begun", source="d"))
def most_frequent_long_texts(spark, folder):
    """Whole documents, and texts that all begin alike and are nearly all different, so that ties decide."""
    docs = table(spark, folder, "documents").selectExpr("text", f"{_BEGUN.format(key='doc_id')} AS begun")
    return P.top_texts(docs, ["text", "begun"])


@query(
    _TOP.format(name="o_orderstatus", source="orders") + " UNION ALL " + _TOP.format(name="o_orderpriority", source="orders")
)
def most_frequent_texts(spark, folder):
    return P.top_texts(table(spark, folder, "orders"), ["o_orderstatus", "o_orderpriority"])


@query(
    f"WITH {GAPPED}, m AS (SELECT count(*) AS n, 3 * count(*) - count(user_id) - count(event_type) - count(value) AS gaps FROM gapped) "
    "SELECT n AS rows, n * 5 AS cells, gaps AS missing_cells, round(gaps::DOUBLE / (n * 5) * 100, 2) AS missing_pct FROM m"
)
def missing_in_all(spark, folder):
    return R.missing_cells(gapped_events(spark, folder))


@query(
    f"{DOUBLED}, d AS (SELECT DISTINCT * FROM doubled), c AS (SELECT (SELECT count(*) FROM doubled) AS rows, (SELECT count(*) FROM d) AS distinct_rows) "
    "SELECT rows, distinct_rows, rows - distinct_rows AS duplicate_rows FROM c"
)
def duplicates_in_all(spark, folder):
    return R.duplicate_rows(doubled_events(spark, folder))


@query("SELECT count(*) AS rows, 11::BIGINT AS columns, count(*) * 11 AS cells FROM lineitem")
def table_shape(spark, folder):
    return R.shape(table(spark, folder, "lineitem"))


_DATE_TEXTS = (
    "SELECT event_id, event_type AS update_kind, substr(CAST(ts AS VARCHAR), 1, 19) AS seen_time, ts AS moment FROM events"
)


@query(
    f"WITH s AS ({_DATE_TEXTS}) "
    "SELECT 'moment' AS \"column\", 'seen_time' AS default_column "
    "UNION ALL SELECT 'seen_time', 'seen_time' FROM s HAVING count(try_cast(seen_time AS TIMESTAMP)) >= 0.8 * count(*) "
    "UNION ALL SELECT 'update_kind', 'seen_time' FROM s HAVING count(try_cast(update_kind AS TIMESTAMP)) >= 0.8 * count(*)"
)
def date_columns(spark, folder):
    """One by type, one by name and content; ``update_kind`` has only the name."""
    texts = table(spark, folder, "events").selectExpr(
        "event_id", "event_type AS update_kind", "substr(CAST(ts AS STRING), 1, 19) AS seen_time", "ts AS moment"
    )
    found = P.datetime_columns(texts)
    return spark.createDataFrame([(name, found[0]) for name in found], "column string, default_column string")


# The rules of the ranking, spelled out for the columns of orders.
_RANKED = (
    "WITH f AS ("
    + " UNION ALL ".join(
        f"SELECT '{name}' AS \"column\", {place} AS ordinal, {points} AS points, count(*) AS n, count(DISTINCT {name}) AS d, "
        f"count(*) - count({name}) AS gaps FROM o"
        for place, (name, points) in enumerate(
            [("customer_id", -80), ("price_total", 48), ("o_orderstatus", 42), ("class", 98), ("note", 0), ("constant", 15)]
        )
    )
    + ") SELECT \"column\", ordinal, (points + CASE WHEN d BETWEEN 2 AND greatest(20, floor(sqrt(n))) THEN 16 ELSE 0 END "
    "+ CASE WHEN gaps < 0.05 * n THEN 6 WHEN gaps > 0.4 * n THEN -35 ELSE 0 END + CASE WHEN d <= 1 THEN -100 ELSE 0 END "
    "+ CASE WHEN d > 0.95 * n THEN -28 ELSE 0 END)::DOUBLE AS score FROM f"
)
_CANDIDATES = (
    "o_custkey AS customer_id", "o_totalprice AS price_total", "o_orderstatus",
    "CASE WHEN o_orderkey % 20 = 0 THEN NULL ELSE o_orderpriority END AS class",
    "CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE o_orderkey END AS note", "1 AS constant",
)


def _candidates(spark, folder):
    return table(spark, folder, "orders").selectExpr(*_CANDIDATES)


_RANKING = f"WITH o AS (SELECT {', '.join(_CANDIDATES)} FROM orders), " + _RANKED.removeprefix("WITH ")


@query(_RANKING)
def target_ranking(spark, folder):
    return P.rank_targets(_candidates(spark, folder)).select("column", "ordinal", "score")


@query(
    f"WITH ranked AS ({_RANKING}), two AS (SELECT *, row_number() OVER (ORDER BY score DESC, ordinal) AS place FROM ranked), "
    "top AS (SELECT a.\"column\" AS target, a.score, a.score - b.score AS lead FROM two a, two b WHERE a.place = 1 AND b.place = 2) "
    "SELECT target, score, lead, CASE WHEN score >= 60 OR lead >= 35 THEN 'high' WHEN lead >= 12 THEN 'medium' ELSE 'low' END AS confidence, "
    "'named class (+98); few outcomes (+16)' AS reason FROM top"
)
def chosen_target(spark, folder):
    return P.choose_target(P.rank_targets(_candidates(spark, folder)))


def _task(name: str, numeric: bool) -> str:
    kind = "" if numeric else "WHEN TRUE THEN 'classification' "
    return (
        f"SELECT '{name}' AS target, count({name}) AS present, count(DISTINCT {name}) AS \"distinct\", "
        f"CASE WHEN count(DISTINCT {name}) < 2 THEN 'unknown' {kind}"
        f"WHEN count(DISTINCT {name}) <= greatest(12, least(50, floor(sqrt(count({name}))))) "
        f"AND count(DISTINCT {name})::DOUBLE / count({name}) <= 0.2 THEN 'classification' ELSE 'regression' END AS task FROM l"
    )


@query(
    "WITH l AS (SELECT l_quantity, l_returnflag, l_extendedprice, 1 AS one FROM lineitem) "
    + " UNION ALL ".join([_task("l_quantity", True), _task("l_returnflag", False), _task("l_extendedprice", True), _task("one", True)])
)
def detected_tasks(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_quantity", "l_returnflag", "l_extendedprice", F.lit(1).alias("one"))
    first, *rest = [P.detect_task(lines, name) for name in lines.columns]
    for other in rest:
        first = first.union(other)
    return first


_KINDS = (("event_id", "numeric"), ("ts", "categorical"), ("user_id", "numeric"), ("event_type", "categorical"), ("value", "numeric"))


@query(
    f"WITH {GAPPED} "
    + " UNION ALL ".join(
        f"SELECT '{name}' AS \"column\", {i} AS ordinal, '{kind}' AS kind, count({name}) AS present FROM gapped HAVING count({name}) > 0" for i, (name, kind) in enumerate(_KINDS)
    )
)
def feature_kinds(spark, folder):
    """The columns with any value; one without is left out."""
    return P.usable_features(gapped_events(spark, folder).withColumn("empty", F.lit(None).cast("string")))


@query(
    f"WITH {GAPPED} "
    + " UNION ALL ".join(
        f"SELECT '{name}' AS \"column\", count(*) AS rows, count(*) - count({name}) AS missing, count(DISTINCT {name}) AS \"distinct\", "
        f"round((count(*) - count({name}))::DOUBLE / count(*) * 100, 2) AS missing_pct, "
        + (f"round(avg({name}), 4) AS mean, round(quantile_cont({name}::DOUBLE, 0.5), 4) AS median" if numeric else "NULL::DOUBLE AS mean, NULL::DOUBLE AS median")
        + " FROM gapped"
        for name, numeric in zip(_COLUMNS, (True, False, True, False, True))
    )
)
def column_profiles(spark, folder):
    wanted = ["column", "rows", "missing", "distinct", "missing_pct", "mean", "median"]
    return P.column_profiles(gapped_events(spark, folder)).select(*wanted)


@query(
    f"{DOUBLED} SELECT count(*) AS rows, 5::BIGINT AS columns, count(*) * 5 AS cells, 'event_type' AS target, 'classification' AS task, 'ts' AS date_column, "
    "3 * count(*) - count(user_id) - count(event_type) - count(value) AS missing_cells, "
    "count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM doubled)) AS duplicate_rows FROM doubled"
)
def whole_profile(spark, folder):
    record = P.profile(doubled_events(spark, folder), order_by=["event_id"])
    keys = ("rows", "columns", "cells", "target", "task", "date_column", "missing_cells", "duplicate_rows")
    kinds = "rows bigint, columns bigint, cells bigint, target string, task string, date_column string, missing_cells bigint, duplicate_rows bigint"
    return spark.createDataFrame([tuple(record[k] for k in keys)], kinds)


@query(
    "SELECT 'o_totalprice' AS target, 'manual' AS target_confidence, 'regression' AS task, 3::BIGINT AS selected, count(*) AS rows FROM orders"
)
def overridden_profile(spark, folder):
    """The caller's own target brings its own task and stays selected."""
    orders = table(spark, folder, "orders")
    record = P.profile(orders, target="o_totalprice", columns=["o_custkey", "o_orderstatus"], date_column="o_orderdate")
    row = (record["target"], record["target_confidence"], record["task"], len(record["selected_columns"]), record["rows"])
    return spark.createDataFrame([row], "target string, target_confidence string, task string, selected bigint, rows bigint")
