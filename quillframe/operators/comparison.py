"""Metrics of several models side by side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from quillframe.operators.models import MODELS, STARTER_PAIRS

# The metrics for which more is better; for all others less is.
HIGHER_IS_BETTER = (
    "accuracy", "precision", "recall", "f1_score", "training_accuracy", "r2", "training_r2",
    "silhouette_score", "squared_silhouette_score", "calinski_harabasz_score", "adjusted_rand_index",
)


def pivot_metrics(metrics: DataFrame, models: Sequence[str]) -> DataFrame:
    """``metric`` and one column per model, from ``model, metric, value``; absent figures are NULL."""
    return metrics.groupBy("metric").pivot("model", list(models)).agg(F.first("value")).orderBy("metric")


def relative_bars(metrics: DataFrame) -> DataFrame:
    """Add ``bar``: the size of a figure in percent of the metric's largest (at least 1), between 1 and 100."""
    size = F.abs("value")
    largest = F.greatest(F.max(size).over(Window.partitionBy("metric")), F.lit(1.0))
    return metrics.withColumn("bar", F.greatest(F.lit(1.0), F.least(F.lit(100.0), size / largest * 100)))


def mark_best(metrics: DataFrame) -> DataFrame:
    """Add ``higher_is_better`` and ``is_best``."""
    higher = F.col("metric").isin(*HIGHER_IS_BETTER)
    per_metric = Window.partitionBy("metric")
    best = F.when(higher, F.max("value").over(per_metric)).otherwise(F.min("value").over(per_metric))
    return metrics.withColumn("higher_is_better", higher).withColumn("is_best", F.col("value") == best)


def starter_models(tasks: DataFrame) -> DataFrame:
    """Add the proposed pair, ``model, place``, to rows with a ``task``; an unknown task gets the clustering pair."""
    pairs = [(task, model, place) for task, pair in STARTER_PAIRS.items() for place, model in enumerate(pair, start=1)]
    rules = tasks.sparkSession.createDataFrame(pairs, "_task string, model string, place int")
    wanted = F.when(F.col("task").isin("classification", "regression"), F.col("task")).otherwise("clustering")
    return tasks.join(F.broadcast(rules), wanted == F.col("_task")).drop("_task")  # six rules


def catalogue(spark: SparkSession) -> DataFrame:
    """``model, name, task`` of the built-in models."""
    return spark.createDataFrame([(k, s.name, s.task) for k, s in MODELS.items()], "model string, name string, task string")
