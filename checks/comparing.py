"""Comparisons of models, and the ledger that keeps them."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query, table
from quillframe.operators.comparison import mark_best, pivot_metrics, relative_bars, starter_models
from quillframe.operators.models import MODELS
from quillframe.plans.compare import compare_models, compatible
from quillframe.plans.profile import detect_task
from quillframe.session import scratch_path
from quillframe.sources.workspace import Workspace

# Figures of three "models" taken from lineitem, to try the layout of comparisons on.
_FIGURES = (
    "SELECT l_returnflag AS model, 'mae' AS metric, round(avg(l_extendedprice), 2) AS value FROM lineitem GROUP BY 1 "
    "UNION ALL SELECT l_returnflag, 'r2', round(avg(l_discount) + 0.0001 * min(l_linenumber), 6) FROM lineitem GROUP BY 1 "
    "UNION ALL SELECT l_returnflag, 'rmse', round(stddev_samp(l_quantity), 6) FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1"
)


def _figures(spark, folder):
    lines = table(spark, folder, "lineitem").groupBy(F.col("l_returnflag").alias("model"))
    rows = lines.agg(
        F.round(F.avg("l_extendedprice"), 2).alias("mae"),
        F.round(F.avg("l_discount") + 0.0001 * F.min("l_linenumber"), 6).alias("r2"),
        F.round(F.stddev_samp("l_quantity"), 6).alias("rmse"),
    )
    long = rows.unpivot(["model"], ["mae", "r2", "rmse"], "metric", "value")
    return long.where("NOT (metric = 'rmse' AND model = 'N')")


@query(
    f"WITH f AS ({_FIGURES}) SELECT metric, max(value) FILTER (model = 'A') AS \"A\", max(value) FILTER (model = 'N') AS \"N\", "
    "max(value) FILTER (model = 'R') AS \"R\" FROM f GROUP BY metric"
)
def side_by_side(spark, folder):
    return pivot_metrics(_figures(spark, folder), ["A", "N", "R"])


@query(
    f"WITH f AS ({_FIGURES}) SELECT *, round(greatest(1, least(100, abs(value) / greatest(max(abs(value)) OVER (PARTITION BY metric), 1) * 100)), 6) AS bar FROM f"
)
def relative_bar(spark, folder):
    return relative_bars(_figures(spark, folder)).withColumn("bar", F.round("bar", 6))


@query(
    f"WITH f AS ({_FIGURES}) SELECT *, metric = 'r2' AS higher_is_better, value = CASE WHEN metric = 'r2' THEN max(value) OVER (PARTITION BY metric) "
    "ELSE min(value) OVER (PARTITION BY metric) END AS is_best FROM f"
)
def best_per_metric(spark, folder):
    return mark_best(_figures(spark, folder))


@query(
    "WITH d AS (SELECT 'o_totalprice' AS target, CASE WHEN count(DISTINCT o_totalprice)::DOUBLE / count(*) > 0.2 OR count(DISTINCT o_totalprice) > 50 THEN 'regression' "
    "ELSE 'classification' END AS task FROM orders UNION ALL SELECT 'o_orderstatus', CASE WHEN count(DISTINCT o_orderstatus) > 1 THEN 'classification' ELSE 'unknown' END FROM orders), "
    "r(task, model, place) AS (VALUES ('regression', 'linear_regression', 1), ('regression', 'random_forest', 2), ('classification', 'decision_tree', 1), "
    "('classification', 'logistic_regression', 2), ('unknown', 'kmeans', 1), ('unknown', 'agglomerative_clustering', 2)) "
    "SELECT target, d.task, model, place::INT AS place FROM d JOIN r ON d.task = r.task"
)
def starter_pair(spark, folder):
    orders = table(spark, folder, "orders")
    tasks = detect_task(orders, "o_totalprice").union(detect_task(orders, "o_orderstatus"))
    return starter_models(tasks.select("target", "task"))


@query(
    "WITH d AS (SELECT CASE WHEN count(DISTINCT o_orderstatus) > 1 THEN 'classification' ELSE 'unknown' END AS task FROM orders), "
    "m(model, own) AS (VALUES ('decision_tree', 'classification'), ('logistic_regression', 'classification'), ('linear_regression', 'regression'), "
    "('random_forest', 'regression'), ('kmeans', 'clustering'), ('agglomerative_clustering', 'clustering')) "
    "SELECT model, task, own = 'clustering' OR own = task AS fits FROM m, d"
)
def model_fit_for_task(spark, folder):
    task = detect_task(table(spark, folder, "orders"), "o_orderstatus").first()["task"]
    return spark.createDataFrame([(m, task, compatible(m, task)) for m in MODELS], "model string, task string, fits boolean")


def _price_run(spark, folder, **extra):
    parts = table(spark, folder, "part").selectExpr("p_partkey", "p_partkey % 1000 AS step", "p_size", "p_retailprice")
    return compare_models(parts, "p_retailprice", ["linear_regression", "random_forest"], key=["p_partkey"], **extra)


@query(
    "SELECT 'Linear Regression' AS model, count(*) AS rows_used, count(*) * 70 // 100 AS train_rows, count(*) - count(*) * 70 // 100 AS test_rows, TRUE AS good, 5::BIGINT AS metrics FROM part "
    "UNION ALL SELECT 'Random Forest', count(*), count(*) * 70 // 100, count(*) - count(*) * 70 // 100, TRUE, 5 FROM part"
)
def compared_models(spark, folder):
    """Two models on the same split: sizes, number of metrics, and whether each explains over half of the variance."""
    run = _price_run(spark, folder)
    rows = [(m.name, m.rows_used, m.train_rows, m.test_rows, m.metrics["r2"] > 0.5, len(m.metrics)) for m in run.models]
    return spark.createDataFrame(rows, "model string, rows_used bigint, train_rows bigint, test_rows bigint, good boolean, metrics bigint")


@query(
    "SELECT 'classification' AS task, 'economy' AS mode, count(*) AS rows_available, least(count(*), 10000) AS rows_processed, 1::BIGINT AS models FROM orders"
)
def ledger_entry(spark, folder):
    """A comparison within a budget, recorded and read back as history."""
    space = Workspace(spark, scratch_path(spark, "workspace"))
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority", "o_orderstatus")
    space.record(compare_models(orders, "o_orderstatus", ["decision_tree"], mode="economy", key=["o_orderkey"]))
    return space.history().select("task", "mode", "rows_available", "rows_processed", F.size("models").cast("bigint").alias("models"))


@query(
    "SELECT 'p_retailprice' AS target, 'full' AS mode, 70 AS train_pct, 'linear_regression' AS first_model, 2::BIGINT AS columns, count(*) AS rows FROM part"
)
def replayed_run(spark, folder):
    """A recorded comparison turned into a request again; the column that the copy lacks is left out."""
    space = Workspace(spark, scratch_path(spark, "workspace"))
    parts = table(spark, folder, "part").selectExpr("p_size", "p_retailprice")
    copy = space.save_copy(parts, "parts")
    run = _price_run(spark, folder, dataset_id=copy, columns=["step", "p_size", "p_retailprice"])
    space.record(run)
    again = space.replays().where(F.col("run_id") == run.id)
    size = space.open_copy(copy).agg(F.count(F.lit(1))).scalar()
    return again.select(
        "target", "mode", "train_pct", F.col("models")[0]["id"].alias("first_model"), F.size("columns").cast("bigint").alias("columns"), size.alias("rows")
    )
