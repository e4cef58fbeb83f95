"""Reading, writing and looking at tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import GAPPED, gapped_events, query, table
from quillframe.functions.missing import fold_missing_tokens, fold_nan
from quillframe.functions.names import with_clean_headers
from quillframe.operators.cleaning import convert_type, remove_missing
from quillframe.session import scratch_path
from quillframe.sources.tables import (
    count_rows, head, preview, preview_json, read_csv, read_parquet, require_content, with_row_key, write_csv,
)
from quillframe.sources.workspace import Workspace


_NOTES = "CASE WHEN event_id % 50 = 0 THEN concat(event_type, chr(10), '\"', CAST(event_id AS VARCHAR(20)), '\"') ELSE event_type END AS note"


@query(f"SELECT event_id, {_NOTES} FROM events")
def csv_with_line_breaks(spark, folder):
    """Line breaks and quotes inside quoted fields."""
    path = scratch_path(spark, "csv")
    write_csv(table(spark, folder, "events").selectExpr("event_id", _NOTES), path)
    return read_csv(spark, path, multiline=True)


_LONG_NOTES = "concat(event_type, CASE WHEN event_id % 3 = 0 THEN concat(chr(10), chr(13), chr(10), '\"x, y\"') ELSE ', z' END)"


@query(f"SELECT event_id, {_LONG_NOTES} AS note, value FROM events")
def csv_of_one_file_in_blocks(spark, folder):
    """One file with line breaks in a third of its rows, cut into records by many tasks."""
    path = scratch_path(spark, "csv")
    write_csv(table(spark, folder, "events").selectExpr("event_id", f"{_LONG_NOTES} AS note", "value").coalesce(1), path)
    return read_csv(spark, path, multiline=True)


@query("SELECT event_id, CASE WHEN event_id % 4 > 0 THEN event_type END AS event_type, CASE WHEN event_id % 4 = 3 THEN value END AS value FROM events")
def csv_with_short_rows(spark, folder):
    """Rows with fewer fields than the header are filled with NULL; none has too many."""
    path = scratch_path(spark, "csv")
    fields = "concat_ws(',', event_id, CASE WHEN event_id % 4 > 0 THEN event_type END, CASE WHEN event_id % 4 = 3 THEN value END) AS line"
    lines = table(spark, folder, "events").selectExpr(fields, "event_id").unionByName(spark.range(1).selectExpr("'event_id,event_type,value' AS line", "id - 1000000000 AS event_id"))
    lines.repartition(1).sortWithinPartitions("event_id").select("line").write.text(path)
    return read_csv(spark, path)


@query("SELECT event_id, event_type, value FROM events")
def csv_of_many_files(spark, folder):
    path = scratch_path(spark, "csv")
    write_csv(table(spark, folder, "events").select("event_id", "event_type", "value").repartition(7, "event_id"), path)
    return read_csv(spark, path)


@query(f"WITH {GAPPED} SELECT * FROM gapped")
def csv_round_trip(spark, folder):
    """Written as CSV and read back with inferred types; the text of the timestamp is parsed again."""
    path = scratch_path(spark, "csv")
    write_csv(gapped_events(spark, folder), path)
    return convert_type(read_csv(spark, path), "ts", "datetime")


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 100")
def first_rows(spark, folder):
    return head(table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), 100, ["o_orderkey"])


@query("SELECT count(*) AS rows FROM lineitem")
def row_count(spark, folder):
    return count_rows(table(spark, folder, "lineitem"))


@query('SELECT p_partkey AS key, p_name AS column_2, p_brand AS x, p_type AS x_2, p_size AS x_3, p_retailprice AS price FROM part')
def clean_headers(spark, folder):
    return with_clean_headers(table(spark, folder, "part").toDF(" key ", "", "x", "x", "x", "price "))


@query(
    "SELECT event_id, CASE WHEN event_id % 6 < 3 THEN NULL WHEN event_id % 6 = 3 THEN '-' ELSE event_type END AS t FROM events"
)
def missing_tokens(spark, folder):
    raw = table(spark, folder, "events").selectExpr(
        "event_id",
        "CASE event_id % 6 WHEN 0 THEN 'NA' WHEN 1 THEN '' WHEN 2 THEN 'null' WHEN 3 THEN '-' ELSE event_type END AS t",
    )
    return fold_missing_tokens(raw)


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS value FROM events")
def nan_as_missing(spark, folder):
    raw = table(spark, folder, "events").selectExpr(
        "event_id", "CASE WHEN event_id % 3 = 0 THEN CAST('NaN' AS DOUBLE) ELSE value END AS value"
    )
    return fold_nan(raw)


@query(
    "SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS o_orderdate "
    "FROM orders ORDER BY o_orderkey LIMIT 12"
)
def preview_rows(spark, folder):
    return preview(table(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderdate"), ["o_orderkey"])


@query(
    "SELECT '{\"o_orderkey\":' || o_orderkey || ',\"o_orderstatus\":\"' || o_orderstatus || '\",\"gap\":null}' AS record "
    "FROM orders ORDER BY o_orderkey LIMIT 12"
)
def preview_records(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", F.lit(None).cast("string").alias("gap"))
    return preview_json(orders, ["o_orderkey"])


@query(f"WITH {GAPPED} SELECT * FROM gapped WHERE user_id IS NOT NULL AND event_type IS NOT NULL AND value IS NOT NULL")
def working_copy(spark, folder):
    """A cleaned table saved as a working copy and opened again, with its types."""
    space = Workspace(spark, scratch_path(spark, "workspace"))
    copy = space.save_copy(remove_missing(gapped_events(spark, folder)), "complete events", message="gaps removed")
    return space.open_copy(copy)


@query(
    "SELECT 1::BIGINT AS place, 'large orders' AS name, 1::BIGINT AS sources, 'filtered' AS message, count(*) AS rows "
    "FROM orders WHERE o_totalprice > 250000 "
    "UNION ALL SELECT 2::BIGINT, 'orders', 0::BIGINT, NULL, count(*) FROM orders"
)
def copies_with_lineage(spark, folder):
    """Two copies, one derived from the other, listed from the newest on, with their row counts."""
    space = Workspace(spark, scratch_path(spark, "workspace"))
    first = space.save_copy(table(spark, folder, "orders"), "orders")
    second = space.save_copy(space.open_copy(first).where("o_totalprice > 250000"), "large orders", [first], "filtered")
    newest = space.listing().select("id", "name", F.size("source_ids").cast("bigint").alias("sources"), "message")
    sizes = [space.open_copy(i).agg(F.count(F.lit(1)).alias("rows")).withColumn("id", F.lit(i)) for i in (first, second)]
    order = [(row["id"], place) for place, row in enumerate(newest.collect(), 1)]  # two copies, in the order of the listing
    placed = newest.join(spark.createDataFrame(order, "id string, place bigint"), "id")
    return placed.join(sizes[0].union(sizes[1]), "id").select("place", "name", "sources", "message", "rows")


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def content_guard(spark, folder):
    return require_content(read_parquet(spark, f"{folder}/customer.parquet")).select("c_custkey", "c_name", "c_acctbal")


@query("SELECT count(*) AS rows, count(*) AS keys FROM lineitem")
def row_keys(spark, folder):
    """A table without key of its own gets one that tells all rows apart."""
    keyed = with_row_key(table(spark, folder, "lineitem"))
    return keyed.groupBy("_row_key").count().agg(F.sum("count").alias("rows"), F.count(F.lit(1)).alias("keys"))
