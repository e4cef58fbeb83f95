"""Joins with missing keys on both sides, and the removal of what they make redundant."""

from __future__ import annotations

from dataclasses import asdict

from pyspark.sql import functions as F

from checks.registry import query, table
from quillframe.operators.joins import join_tables

_ORDERS = "SELECT o_orderkey, CASE WHEN o_custkey IN (1, 2) THEN NULL ELSE o_custkey END AS cust, o_totalprice FROM orders"
_CUSTOMERS = (
    "SELECT CASE WHEN c_custkey = 5 THEN NULL WHEN c_custkey % 3 = 0 THEN -c_custkey ELSE c_custkey END AS c_custkey, c_name, c_acctbal FROM customer"
)
_SIDES = f"WITH o AS ({_ORDERS}), c AS ({_CUSTOMERS})"


def _orders(spark, folder):
    return table(spark, folder, "orders").selectExpr(
        "o_orderkey", "CASE WHEN o_custkey IN (1, 2) THEN NULL ELSE o_custkey END AS cust", "o_totalprice"
    )


def _customers(spark, folder):
    return table(spark, folder, "customer").selectExpr(
        "CASE WHEN c_custkey = 5 THEN NULL WHEN c_custkey % 3 = 0 THEN -c_custkey ELSE c_custkey END AS c_custkey", "c_name", "c_acctbal"
    )


def _joined(spark, folder, how):
    return join_tables(_orders(spark, folder), _customers(spark, folder), "cust", "c_custkey", how, keep=["c_custkey"]).table


@query(f"{_SIDES} SELECT o.*, c.* FROM o JOIN c ON cust IS NOT DISTINCT FROM c_custkey")
def inner_join(spark, folder):
    return _joined(spark, folder, "inner")


@query(f"{_SIDES} SELECT o.*, c.* FROM o LEFT JOIN c ON cust IS NOT DISTINCT FROM c_custkey")
def left_join(spark, folder):
    return _joined(spark, folder, "left")


@query(f"{_SIDES} SELECT o.*, c.* FROM o RIGHT JOIN c ON cust IS NOT DISTINCT FROM c_custkey")
def right_join(spark, folder):
    return _joined(spark, folder, "right")


@query(
    f"{_SIDES} SELECT o.*, c.* FROM o LEFT JOIN c ON cust IS NOT DISTINCT FROM c_custkey UNION ALL "
    "SELECT NULL, NULL, NULL, c.* FROM c WHERE NOT EXISTS (SELECT 1 FROM o WHERE cust IS NOT DISTINCT FROM c_custkey)"
)
def outer_join(spark, folder):
    return _joined(spark, folder, "outer")


@query(
    "WITH l AS (SELECT s_suppkey * 2 AS key, s_acctbal AS balance FROM supplier), "
    "r AS (SELECT c_custkey * 3 AS key, c_acctbal AS balance FROM customer) "
    "SELECT coalesce(l.key, r.key) AS key, l.balance AS balance_left, r.balance AS balance_right FROM l FULL JOIN r ON l.key = r.key"
)
def shared_key_and_suffixes(spark, folder):
    left = table(spark, folder, "supplier").selectExpr("s_suppkey * 2 AS key", "s_acctbal AS balance")
    right = table(spark, folder, "customer").selectExpr("c_custkey * 3 AS key", "c_acctbal AS balance")
    return join_tables(left, right, "key", "key", "outer").table


def _twins(spark, folder):
    """Two tables on orders with one column the same, one different, and keys of different names."""
    orders = table(spark, folder, "orders")
    left = orders.selectExpr("o_orderkey AS a_key", "o_orderstatus AS status", "o_custkey AS cust")
    right = orders.selectExpr("o_orderkey AS b_key", "o_orderstatus AS status", "o_custkey + o_orderkey % 2 AS cust")
    return left, right


_TWINS = (
    "WITH l AS (SELECT o_orderkey AS a_key, o_orderstatus AS status, o_custkey AS cust FROM orders), "
    "r AS (SELECT o_orderkey AS b_key, o_orderstatus AS status, o_custkey + o_orderkey % 2 AS cust FROM orders)"
)


@query(
    f"{_TWINS} SELECT a_key, l.status AS status_left, l.cust AS cust_left, r.cust AS cust_right FROM l JOIN r ON a_key = b_key"
)
def redundant_columns_dropped(spark, folder):
    left, right = _twins(spark, folder)
    return join_tables(left, right, "a_key", "b_key").table


@query(
    f"{_TWINS}, j AS (SELECT a_key, b_key, l.status AS s1, r.status AS s2, l.cust AS c1, r.cust AS c2 FROM l JOIN r ON a_key = b_key), "
    "v AS (SELECT bool_and(s1 IS NOT DISTINCT FROM s2) AS s, bool_and(c1 IS NOT DISTINCT FROM c2) AS c, bool_and(a_key IS NOT DISTINCT FROM b_key) AS k FROM j) "
    "SELECT 'status_right' AS \"column\", 'status_left' AS matches, 'same values as the left column' AS reason FROM v WHERE s "
    "UNION ALL SELECT 'cust_right', 'cust_left', 'same values as the left column' FROM v WHERE c "
    "UNION ALL SELECT 'b_key', 'a_key', 'same values as the left key' FROM v WHERE k"
)
def redundant_column_report(spark, folder):
    left, right = _twins(spark, folder)
    removed = join_tables(left, right, "a_key", "b_key").removed
    return spark.createDataFrame([tuple(asdict(r).values()) for r in removed], "column string, matches string, reason string")


@query(
    f"{_TWINS} SELECT a_key, l.status AS status_left, l.cust AS cust_left, b_key, r.status AS status_right, r.cust AS cust_right "
    "FROM l JOIN r ON a_key = b_key"
)
def redundant_columns_kept(spark, folder):
    left, right = _twins(spark, folder)
    return join_tables(left, right, "a_key", "b_key", keep=["status_right", "b_key"]).table


@query(
    "SELECT n_nationkey AS nation, n_name AS country, r_name AS area FROM nation JOIN region ON n_regionkey = r_regionkey"
)
def renames_around_join(spark, folder):
    joined = join_tables(
        table(spark, folder, "nation"),
        table(spark, folder, "region"),
        "n_regionkey",
        "r_regionkey",
        left_rename={"n_regionkey": "region", "n_nationkey": "nation"},
        right_rename={"r_regionkey": "region"},
        rename={"n_name": "country", "r_name": "area"},
    )
    return joined.table.drop("region")
