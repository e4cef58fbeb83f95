"""The query register, and the damaged tables that the queries start from.

The supplied tables have no gaps and no copies, so both are put in by an expression that reads the same in
Spark and in SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Query, str | None]] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        if run.__name__ in REGISTRY:
            raise ValueError(f"There are two queries named {run.__name__}.")
        REGISTRY[run.__name__] = (run, sql)
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


GAPPED_COLUMNS = (
    "event_id",
    "ts",
    "CASE WHEN event_id % 13 = 0 THEN NULL ELSE user_id END AS user_id",
    "CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_type END AS event_type",
    "CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS value",
)
GAPPED = f"gapped AS (SELECT {', '.join(GAPPED_COLUMNS)} FROM events)"


def gapped_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events with gaps in ``user_id``, ``event_type`` and ``value``."""
    return table(spark, folder, "events").selectExpr(*GAPPED_COLUMNS)


DOUBLED = f"WITH {GAPPED}, doubled AS (SELECT * FROM gapped UNION ALL SELECT * FROM gapped WHERE event_id % 5 = 0)"


def doubled_events(spark: SparkSession, folder: str) -> DataFrame:
    """The gapped events, every fifth one twice."""
    events = gapped_events(spark, folder)
    return events.union(events.where("event_id % 5 = 0"))


MIXED_TEXT = (
    "CASE event_id % 9 WHEN 0 THEN '0.5' WHEN 1 THEN '1.5' WHEN 2 THEN 'x' WHEN 3 THEN ' 7 ' WHEN 4 THEN '1e3' "
    "WHEN 5 THEN 'Yes' WHEN 6 THEN concat(CAST(event_id AS VARCHAR(20)), '.5') WHEN 7 THEN NULL "
    "ELSE CAST(event_id AS VARCHAR(20)) END AS t"
)
DATE_TEXT = (
    "CASE event_id % 4 WHEN 0 THEN substr(CAST(ts AS VARCHAR(30)), 1, 19) "
    "WHEN 1 THEN concat(substr(CAST(ts AS VARCHAR(30)), 6, 2), '/', substr(CAST(ts AS VARCHAR(30)), 9, 2), '/', "
    "substr(CAST(ts AS VARCHAR(30)), 1, 4)) WHEN 2 THEN 'no date' ELSE NULL END AS t"
)


def text_events(spark: SparkSession, folder: str, expression: str) -> DataFrame:
    return table(spark, folder, "events").selectExpr("event_id", expression)


def below(pct: int) -> int:
    """The hash below which ``pct`` percent of the range lies."""
    return (1 << 60) * pct // 100


def draw(key: str, seed: int = 42) -> str:
    """The row hash in DuckDB."""
    return f"('0x' || substr(md5({key}::VARCHAR || ':{seed}'), 1, 15))::BIGINT"
