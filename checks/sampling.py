"""Samples and splits by row hash."""

from __future__ import annotations

from checks.registry import DOUBLED, below, doubled_events, draw, query, table
from quillframe.operators import sampling as S

_RANK = f"row_number() OVER (ORDER BY {draw('o_orderkey')}, o_orderkey)"


@query(
    "WITH c AS (SELECT count(*) AS n FROM lineitem) SELECT 'economy' AS mode, 10000::BIGINT AS row_limit, least(n, 10000) AS rows_used FROM c "
    "UNION ALL SELECT 'balanced', 50000, least(n, 50000) FROM c UNION ALL SELECT 'full', NULL, n FROM c"
)
def budget_plan(spark, folder):
    return S.budget_plan(table(spark, folder, "lineitem"))


@query(f"SELECT o_orderkey, o_totalprice FROM orders QUALIFY {_RANK} <= 10000")
def budget_sample(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return S.within_budget(orders, "sample", ["o_orderkey"])


@query(f"SELECT o_orderkey, o_orderstatus FROM orders QUALIFY {_RANK} <= 777")
def hash_sample(spark, folder):
    return S.hash_sample(table(spark, folder, "orders").select("o_orderkey", "o_orderstatus"), 777, ["o_orderkey"])


@query(
    f"SELECT o_orderkey, CASE WHEN {draw('o_orderkey')} < {below(70)} THEN 'train' ELSE 'test' END AS split FROM orders"
)
def random_split(spark, folder):
    return S.random_split(table(spark, folder, "orders").select("o_orderkey"), 70, ["o_orderkey"])


@query(f"SELECT o_orderkey, CASE WHEN {_RANK} <= (SELECT count(*) * 70 // 100 FROM orders) THEN 'train' ELSE 'test' END AS split FROM orders")
def exact_split(spark, folder):
    return S.random_split(table(spark, folder, "orders").select("o_orderkey"), 70, ["o_orderkey"], exact=True)


@query(
    "WITH c AS (SELECT o_orderpriority AS k, count(*) AS n, count(*) * 33 // 100 AS base, count(*) * 33 % 100 AS rest FROM orders GROUP BY 1), "
    "q AS (SELECT k, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, k) <= (SELECT sum(n) * 33 // 100 - sum(base) FROM c) THEN 1 ELSE 0 END AS take FROM c) "
    f"SELECT o_orderkey, o_orderpriority, CASE WHEN row_number() OVER (PARTITION BY o_orderpriority ORDER BY {draw('o_orderkey')}, o_orderkey) <= take "
    "THEN 'train' ELSE 'test' END AS split FROM orders JOIN q ON k = o_orderpriority"
)
def stratified_split(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    return S.stratified_split(orders, "o_orderpriority", 33, ["o_orderkey"])


_KEYLESS = "('0x' || substr(md5(concat_ws(':', event_id::VARCHAR, coalesce(user_id::VARCHAR, ''), coalesce(event_type, ''), '42')), 1, 15))::BIGINT"


@query(f"{DOUBLED} SELECT event_id, user_id, event_type, CASE WHEN {_KEYLESS} < {below(70)} THEN 'train' ELSE 'test' END AS split FROM doubled")
def split_without_key(spark, folder):
    """The whole row is the key, so copies fall on one side."""
    return S.random_split(doubled_events(spark, folder).select("event_id", "user_id", "event_type"), 70)


@query("SELECT c_custkey, c_mktsegment FROM customer")
def enough_rows(spark, folder):
    return S.require_rows(table(spark, folder, "customer").select("c_custkey", "c_mktsegment"))
