"""Evaluation metrics as aggregations over predictions, whatever produced them.

Classification metrics start from the confusion counts, which are pre-aggregated in each task, so a
dominant class is one counter. Clustering scores use every row in a few aggregations, but for the Euclidean
silhouette, which compares blocks of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from quillframe.errors import TableError
from quillframe.functions.types import quoted
from quillframe.operators.silhouette import euclidean_silhouette

SAMPLE_PAIRS = 80  # fixed value: actual-against-predicted pairs kept for a chart
MAX_LABELS = 10_000  # of a matrix that lists all pairs
MAX_CLUSTERS = 10_000  # that are compared in pairs
DIGITS = 5  # fixed value: decimal places of reported metrics


def long_form(figures: DataFrame) -> DataFrame:
    """A one-row table of figures as ``metric, value``, rounded."""
    rows = [
        F.struct(F.lit(n).alias("metric"), F.round(quoted(n).cast("double"), DIGITS).alias("value"))
        for n in figures.columns
    ]
    return figures.select(F.inline(F.array(*rows)))


# Classification


def confusion_counts(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """``actual, predicted, n`` by text, for the pairs that occur."""
    return df.groupBy(
        quoted(actual).cast("string").alias("actual"), quoted(predicted).cast("string").alias("predicted")
    ).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """``actual, predicted, n`` for every pair of labels seen on either side, with zeros.

    The size is the square of the number of labels by definition; :func:`confusion_counts` leaves the
    zeros out.
    """
    return matrix_of(confusion_counts(df, actual, predicted))


def matrix_of(counts: DataFrame) -> DataFrame:
    """:func:`confusion_matrix` from confusion counts."""
    label_rows = counts.select(F.explode(F.array("actual", "predicted")).alias("label")).distinct()
    all_labels = _all_of(label_rows, F.col("label"), MAX_LABELS, "A full confusion matrix has too many labels; use confusion_counts.")
    grid = label_rows.select(F.col("label").alias("actual"), F.explode(all_labels).alias("predicted"))
    return grid.join(counts, ["actual", "predicted"], "left").select(
        "actual", "predicted", F.coalesce("n", F.lit(0)).alias("n")
    )


def classification_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """One row: ``accuracy, precision, recall, f1_score``, weighted by class size; 0 where a ratio is undefined."""
    return scores_of(confusion_counts(df, actual, predicted))


def scores_of(counts: DataFrame) -> DataFrame:
    """:func:`classification_metrics` from confusion counts."""
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)
    sides = counts.select(
        F.inline(
            F.array(
                F.struct(F.col("actual").alias("label"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("called"), hit.alias("hits")),
                F.struct(F.col("predicted").alias("label"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("called"), F.lit(0).cast("bigint").alias("hits")),
            )
        )
    )
    per_class = sides.groupBy("label").agg(
        F.sum("support").alias("support"), F.sum("called").alias("called"), F.sum("hits").alias("hits")
    )
    scored = per_class.select(
        "support",
        "hits",
        _ratio(F.col("hits"), F.col("called")).alias("precision"),
        _ratio(F.col("hits"), F.col("support")).alias("recall"),
        _ratio(2 * F.col("hits"), F.col("called") + F.col("support")).alias("f1"),
    )
    total = F.sum("support")
    return scored.agg(
        F.try_divide(F.sum("hits"), total).alias("accuracy"),
        *[
            F.try_divide(F.sum(F.col(name) * F.col("support")), total).alias(alias)
            for name, alias in (("precision", "precision"), ("recall", "recall"), ("f1", "f1_score"))
        ],
    )


def accuracy(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """One row: ``accuracy``."""
    same = quoted(actual).cast("string").eqNullSafe(quoted(predicted).cast("string"))
    return df.agg(F.avg(same.cast("double")).alias("accuracy"))


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


# Regression


def regression_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """One row: ``mae, mse, rmse, r2``, from one pass over the rows.

    The total sum of squares comes from Spark's population variance, which is updated row by row around a
    running mean, not from a difference of large sums.
    """
    a = quoted(actual).cast("double")
    error = a - quoted(predicted).cast("double")
    sums = df.agg(
        F.avg(F.abs(error)).alias("mae"), F.avg(error * error).alias("mse"), F.var_pop(a).alias("spread")
    )
    return sums.select("mae", "mse", F.sqrt("mse").alias("rmse"), _r2(F.col("mse"), F.col("spread")).alias("r2"))


def r2(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """One row: ``r2``."""
    return regression_metrics(df, actual, predicted).select("r2")


def _r2(mse: Column, spread: Column) -> Column:
    """Without spread a perfect fit scores 1 and any other 0."""
    return F.when(spread == 0, F.when(mse == 0, 1.0).otherwise(0.0)).otherwise(1 - F.try_divide(mse, spread))


def actual_predicted_sample(
    df: DataFrame, actual: str, predicted: str, order_by: Sequence[str], n: int = SAMPLE_PAIRS
) -> DataFrame:
    """The first ``n`` pairs in the given order."""
    chosen = df.orderBy(*[quoted(name) for name in order_by]).limit(n)
    return chosen.select(*[quoted(name) for name in order_by], quoted(actual).alias("actual"), quoted(predicted).alias("predicted"))


# Clustering


def cluster_sizes(df: DataFrame, label: str) -> DataFrame:
    """``cluster, size``."""
    return df.groupBy(quoted(label).alias("cluster")).agg(F.count(F.lit(1)).alias("size"))


def cluster_count(df: DataFrame, label: str) -> DataFrame:
    """One row: ``clusters, rows, scorable``; scores need at least two clusters and fewer than rows."""
    return (
        cluster_sizes(df, label)
        .agg(F.count(F.lit(1)).alias("clusters"), F.coalesce(F.sum("size"), F.lit(0)).alias("rows"))
        .withColumn("scorable", (F.col("clusters") > 1) & (F.col("clusters") < F.col("rows")))
    )


def adjusted_rand_index(df: DataFrame, truth: str, label: str) -> DataFrame:
    """One row: ``adjusted_rand_index`` between the target's text and the clusters; a missing target is a class of its own."""
    cells = df.groupBy(quoted(truth).cast("string").alias("t"), quoted(label).cast("string").alias("c")).agg(
        F.count(F.lit(1)).alias("n")
    )
    margins = cells.select(
        "n",
        F.inline(
            F.array(
                F.struct(F.lit("t").alias("side"), F.col("t").alias("key")),
                F.struct(F.lit("c").alias("side"), F.col("c").alias("key")),
                F.struct(F.lit("cell").alias("side"), F.lit(None).cast("string").alias("key")),
            )
        ),
    )

    def pairs(n: Column) -> Column:
        n = n.cast("double")
        return n * (n - 1) / 2

    # Cells are summed by their own pair counts, margins by those of their totals.
    per_key = margins.groupBy("side", "key").agg(F.sum("n").alias("total"), F.sum(pairs(F.col("n"))).alias("own"))
    s = per_key.agg(
        F.sum(F.when(F.col("side") == "cell", F.col("own"))).alias("both"),
        F.sum(F.when(F.col("side") == "t", pairs(F.col("total")))).alias("by_truth"),
        F.sum(F.when(F.col("side") == "c", pairs(F.col("total")))).alias("by_cluster"),
        pairs(F.sum(F.when(F.col("side") == "cell", F.col("total")))).alias("all_pairs"),
    )
    expected = F.try_divide(F.col("by_truth") * F.col("by_cluster"), F.col("all_pairs"))
    best = (F.col("by_truth") + F.col("by_cluster")) / 2
    index = F.try_divide(F.col("both") - expected, best - expected)
    return s.select(F.coalesce(index, F.lit(1.0)).alias("adjusted_rand_index"))


def inertia(df: DataFrame, features: Sequence[str] | str, label: str) -> DataFrame:
    """One row: ``inertia``, the summed squared distance of the rows to the mean of their cluster."""
    return _cluster_moments(_points(df, features, label)).agg(F.sum("within").alias("inertia"))


def calinski_harabasz(df: DataFrame, features: Sequence[str] | str, label: str) -> DataFrame:
    """One row: ``calinski_harabasz_score``; NULL unless there are two clusters and fewer than rows."""
    points = _points(df, features, label)
    totals = _cluster_moments(points).agg(
        F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"), F.sum("within").alias("within")
    )
    # What lies between the clusters is the spread of all rows around their one centre, less that within the clusters.
    spread = _cluster_moments(points.withColumn("label", F.lit(0))).agg(F.first("within")).scalar()
    figures = totals.select("k", "n", "within", (spread - F.col("within")).alias("between"))
    score = F.when(F.col("within") == 0, F.lit(1.0)).otherwise(
        F.try_divide(
            F.col("between") * (F.col("n") - F.col("k")), F.col("within") * (F.col("k") - 1)
        )
    )
    usable = (F.col("k") > 1) & (F.col("k") < F.col("n"))
    return figures.select(F.when(usable, score).alias("calinski_harabasz_score"))


def davies_bouldin(df: DataFrame, features: Sequence[str] | str, label: str) -> DataFrame:
    """One row: ``davies_bouldin_score``; NULL unless there are two clusters and fewer than rows.

    Rows are only compared with the centre of their cluster, so the table can be of any size; clusters are compared in pairs.
    """
    points = _points(df, features, label)
    clusters = _cluster_moments(points)
    centres = clusters.select("label", "centre")
    scatter = (
        points.join(centres, "label")
        .groupBy("label")
        .agg(F.avg(_distance(F.col("x"), F.col("centre"))).alias("scatter"), F.count(F.lit(1)).alias("n"), F.first("centre").alias("centre"))
    )
    entry = F.struct("label", "scatter", "centre")
    others = _all_of(scatter, entry, MAX_CLUSTERS, "The Davies-Bouldin score compares all pairs of clusters; there are too many.")

    def likeness(other: Column) -> Column:
        apart = _distance(F.col("centre"), other["centre"])
        return F.coalesce(F.try_divide(F.col("scatter") + other["scatter"], apart), F.lit(0.0))

    rivals = F.filter("others", lambda o: o["label"] != F.col("label"))
    compared = scatter.withColumn("others", others)
    scored = compared.select("n", F.array_max(F.transform(rivals, likeness)).alias("worst")).agg(
        F.avg("worst").alias("score"), F.count(F.lit(1)).alias("k"), F.sum("n").alias("n")
    )
    usable = (F.col("k") > 1) & (F.col("k") < F.col("n"))
    return scored.select(F.when(usable, F.col("score")).alias("davies_bouldin_score"))


def silhouette(df: DataFrame, features: Sequence[str] | str, label: str, rows: int | None = None) -> DataFrame:
    """One row: ``silhouette_score``, the mean Euclidean silhouette; NULL unless there are two clusters and fewer than rows.

    Every row is compared with all others, or ``rows`` of them, drawn by hash, if that is given: then the work is linear in the
    table. Rows without a cluster are left out. See :mod:`quillframe.operators.silhouette`.
    """
    points = _points(df, features, label).select(F.col("label").cast("string").alias("label"), "x").where("label IS NOT NULL")
    score = euclidean_silhouette(points, _cluster_moments(points), rows)
    return df.sparkSession.range(1).select((F.lit(None) if score is None else score).cast("double").alias("silhouette_score"))


def squared_silhouette(df: DataFrame, features: str, label: str) -> DataFrame:
    """One row: ``squared_silhouette_score``, the mean silhouette by squared distances of all rows; NULL unless there are two clusters and fewer than rows.

    Squared distances to all rows of a cluster follow from its moments, so the work is linear in the rows.
    """
    spark = df.sparkSession
    usable = cluster_count(df, label).first()["scorable"]
    score = None
    if usable:
        held = df.select(quoted(features).alias("features"), quoted(label).cast("double").alias("prediction"))
        score = float(ClusteringEvaluator(metricName="silhouette", distanceMeasure="squaredEuclidean").evaluate(held))
    return spark.range(1).select(F.lit(score).cast("double").alias("squared_silhouette_score"))


def _points(df: DataFrame, features: Sequence[str] | str, label: str) -> DataFrame:
    """``label, x`` with the features as one array of doubles."""
    if isinstance(features, str):
        x = quoted(features)
        if df.schema[features].dataType.typeName() != "array":
            x = vector_to_array(x)
        x = x.cast("array<double>")
    else:
        x = F.array(*[quoted(name).cast("double") for name in features])
    return df.select(quoted(label).alias("label"), x.alias("x"))


def _cluster_moments(points: DataFrame) -> DataFrame:
    """``label, n, centre, within`` in one aggregation, partial sums in each task."""
    vector = array_to_vector(F.col("x"))
    summary = points.groupBy("label").agg(
        Summarizer.metrics("mean", "variance", "count").summary(vector).alias("s")
    )
    spread = F.aggregate(vector_to_array(F.col("s.variance")), F.lit(0.0), lambda total, v: total + v)
    n = F.col("s.count")
    within = F.when(n > 1, spread * (n - 1)).otherwise(0.0)
    return summary.select("label", n.alias("n"), vector_to_array(F.col("s.mean")).alias("centre"), within.alias("within"))


def _all_of(df: DataFrame, entry: Column, limit: int, complaint: str) -> Column:
    """The entries of a small table as one array; an error, not a cut, if there are more than ``limit``."""
    gathered = df.select(entry.alias("entry")).limit(limit + 1).agg(F.array_sort(F.collect_list("entry")).alias("all"))
    return gathered.select(F.when(F.size("all") > limit, F.raise_error(F.lit(complaint))).otherwise(F.col("all"))).scalar()


def _distance(a: Column, b: Column) -> Column:
    squares = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, v: total + v))
