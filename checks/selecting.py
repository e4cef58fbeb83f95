"""Columns and row conditions."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import GAPPED, gapped_events, query, table
from quillframe.operators.predicates import EVERY_ROW, field, keep_rows
from quillframe.operators.projection import (
    drop_columns, rename_columns, rows_with_any_feature, rows_with_target, select_columns,
)


@query("SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def select_with_target(spark, folder):
    return select_columns(table(spark, folder, "orders"), ["o_orderkey", "o_totalprice", "nothing"], "o_orderstatus")


@query("SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders")
def drop_named_columns(spark, folder):
    return drop_columns(table(spark, folder, "orders"), ["o_orderdate", "o_orderstatus", "nothing"])


@query("SELECT r_regionkey AS key, r_name FROM region")
def rename_named_columns(spark, folder):
    return rename_columns(table(spark, folder, "region"), {"r_regionkey": " key ", "r_name": " ", "nothing": "x"})


@query(f"WITH {GAPPED} SELECT event_id, event_type FROM gapped WHERE coalesce(event_type = 'error', FALSE)")
def equal_condition(spark, folder):
    return keep_rows(gapped_events(spark, folder), field("event_type") == "error").select("event_id", "event_type")


@query(f"WITH {GAPPED} SELECT event_id, event_type FROM gapped WHERE event_type IS DISTINCT FROM 'error'")
def unequal_condition(spark, folder):
    """A missing value differs from every literal."""
    return keep_rows(gapped_events(spark, folder), field("event_type") != "error").select("event_id", "event_type")


@query(
    f"WITH {GAPPED} SELECT event_id, coalesce(value < 20, FALSE) AS lt, coalesce(value <= 20, FALSE) AS le, "
    "coalesce(value > 20, FALSE) AS gt, coalesce(value >= 20, FALSE) AS ge FROM gapped"
)
def ordering_conditions(spark, folder):
    events, value = gapped_events(spark, folder), field("value")
    tests = {"lt": value < 20, "le": value <= 20, "gt": value > 20, "ge": value >= 20}
    return events.select("event_id", *[test.on(events).alias(name) for name, test in tests.items()])


@query(f"WITH {GAPPED} SELECT event_id, value IS NULL AS gap, user_id IS NOT NULL AS known FROM gapped")
def null_conditions(spark, folder):
    events = gapped_events(spark, folder)
    return events.select(
        "event_id", (field("value") == None).on(events).alias("gap"), (field("user_id") != None).on(events).alias("known")  # noqa: E711
    )


@query(
    f"WITH {GAPPED} SELECT event_id FROM gapped WHERE (coalesce(value > 50, FALSE) OR event_type IS NULL) "
    "AND user_id IS DISTINCT FROM 3 OR coalesce(value < 1, FALSE)"
)
def combined_conditions(spark, folder):
    wanted = ((field("value") > 50) | (field("event_type") == None)) & (field("user_id") != 3) | (field("value") < 1)  # noqa: E711
    return keep_rows(gapped_events(spark, folder), wanted).select("event_id")


@query(
    "SELECT p_partkey, p_size < 2 AS below, p_size = 2 AS same, p_retailprice < 950.5 AS cheap FROM part"
)
def typed_literals(spark, folder):
    """A whole-number column takes 2.5 and 2.9 as 2; a floating one keeps the fraction."""
    part = table(spark, folder, "part")
    tests = {"below": field("p_size") < 2.5, "same": field("p_size") == "2.9", "cheap": field("p_retailprice") < "950.5"}
    return part.select("p_partkey", *[test.on(part).alias(name) for name, test in tests.items()])


@query("SELECT n_nationkey, n_name FROM nation")
def empty_condition(spark, folder):
    return keep_rows(table(spark, folder, "nation"), EVERY_ROW).select("n_nationkey", "n_name")


@query(f"WITH {GAPPED} SELECT event_id, event_type FROM gapped WHERE event_type IS NOT NULL")
def target_present(spark, folder):
    return rows_with_target(gapped_events(spark, folder), "event_type").select("event_id", "event_type")


@query(f"WITH {GAPPED} SELECT event_id FROM gapped WHERE user_id IS NOT NULL OR event_type IS NOT NULL OR value IS NOT NULL")
def any_feature_present(spark, folder):
    return rows_with_any_feature(gapped_events(spark, folder), ["user_id", "event_type", "value"]).select("event_id")
