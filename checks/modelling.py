"""Models on data with a planted signal, for which the right answer is known."""

from __future__ import annotations

from pyspark.ml.classification import NaiveBayes
from pyspark.sql import functions as F

from checks.registry import below, draw, query, table
from quillframe.operators.features import fit_features
from quillframe.operators.models import CustomModel, fit_custom, fit_model, parameters
from quillframe.operators.single_linkage import single_linkage
from quillframe.operators.sampling import random_split, split_parts
from quillframe.plans.compare import ModelRequest, compare_models

# Orders in haste are those of the two highest priorities, but for one in ten orders it is the other way round.
_URGENT = "o_orderpriority IN ('1-URGENT', '2-HIGH')"
_HASTE = f"CASE WHEN ({_URGENT}) <> (o_orderkey % 10 = 3) THEN 'fast' ELSE 'slow' END AS haste"
_TEST_CONFUSION = (
    f"WITH o AS (SELECT *, {_HASTE} FROM orders), c AS (SELECT haste, count(*) AS n, count(*) * 70 // 100 AS base, count(*) * 70 % 100 AS rest FROM o GROUP BY 1), "
    "t AS (SELECT haste, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, haste) <= (SELECT sum(n) * 70 // 100 - sum(base) FROM c) THEN 1 ELSE 0 END AS take FROM c), "
    f"r AS (SELECT *, row_number() OVER (PARTITION BY haste ORDER BY {draw('o_orderkey')}, o_orderkey) AS place FROM o) "
    f"SELECT r.haste AS actual, CASE WHEN {_URGENT} THEN 'fast' ELSE 'slow' END AS predicted, count(*) AS n FROM r JOIN t ON r.haste = t.haste WHERE place > take GROUP BY 1, 2"
)


def _hasty(spark, folder):
    return table(spark, folder, "orders").selectExpr("o_orderkey", "o_orderpriority", _HASTE)


def _confusion(spark, folder, request):
    run = compare_models(_hasty(spark, folder), "haste", [request], key=["o_orderkey"])
    return run.models[0].chart


@query(_TEST_CONFUSION)
def decision_tree(spark, folder):
    return _confusion(spark, folder, "decision_tree")


@query(_TEST_CONFUSION)
def decision_tree_entropy(spark, folder):
    return _confusion(spark, folder, ModelRequest("decision_tree", {"criterion": "entropy", "max_depth": 4, "min_samples_leaf": 5}))


@query(_TEST_CONFUSION)
def logistic_regression(spark, folder):
    return _confusion(spark, folder, "logistic_regression")


@query(_TEST_CONFUSION)
def logistic_regression_balanced(spark, folder):
    return _confusion(spark, folder, ModelRequest("logistic_regression", {"class_weight": "balanced"}))


_PART_TEST = f"{draw('p_partkey')} >= {below(70)}"


def _priced(spark, folder):
    """Training rows, test rows and features of parts, whose price is a line in ``step``."""
    parts = table(spark, folder, "part").selectExpr(
        "p_partkey", "p_partkey % 1000 AS step", "1000 - p_partkey % 1000 AS left_over", "p_size", "p_brand", "p_retailprice AS label"
    )
    return split_parts(random_split(parts, 70, ["p_partkey"]))


def _predicted(spark, folder, model, params, columns):
    train, test = _priced(spark, folder)
    plan = fit_features(train, columns)
    ready = plan.apply(train, training=True)
    fitted = fit_model(model, parameters(model, params), ready, ready.count(), 42)
    return fitted.predict(plan.apply(test))


_LINE = f"SELECT p_partkey, round(900 + 0.1::DOUBLE * (p_partkey % 1000), 2) AS predicted FROM part WHERE {_PART_TEST}"


@query(_LINE)
def linear_regression(spark, folder):
    answers = _predicted(spark, folder, "linear_regression", {}, ["step", "p_size", "p_brand"])
    return answers.select("p_partkey", F.round("prediction", 2).alias("predicted"))


@query(
    f"SELECT p_partkey, round((SELECT avg(p_retailprice) FROM part WHERE NOT ({_PART_TEST})), 2) AS predicted FROM part WHERE {_PART_TEST}"
)
def linear_regression_held_at_zero(spark, folder):
    """The price falls in ``left_over``, so its coefficient is held at zero and the mean is left."""
    answers = _predicted(spark, folder, "linear_regression", {"positive": True}, ["left_over"])
    return answers.select("p_partkey", F.round("prediction", 2).alias("predicted"))


@query(_LINE)
def linear_regression_positive(spark, folder):
    answers = _predicted(spark, folder, "linear_regression", {"positive": True}, ["step"])
    return answers.select("p_partkey", F.round("prediction", 2).alias("predicted"))


@query(f"SELECT count(*) AS rows, TRUE AS beats_the_mean FROM part WHERE {_PART_TEST}")
def random_forest(spark, folder):
    answers = _predicted(spark, folder, "random_forest", {}, ["step", "p_size"])
    error = F.avg(F.pow(F.col("label") - F.col("prediction"), 2))
    return answers.agg(F.count(F.lit(1)).alias("rows"), (error < 0.1 * F.var_pop("label")).alias("beats_the_mean"))


_ACROSS = "(o_orderkey % 3) * 100 + o_totalprice / 500000 AS x"


def _grouped(spark, folder, across=_ACROSS):
    """Three groups of orders far apart from one another."""
    return table(spark, folder, "orders").selectExpr("o_orderkey", "o_orderkey % 3 AS planted", across, "(o_orderkey % 3) * 50 + o_custkey % 5 AS y")


_GROUPS = "SELECT o_orderkey % 3 AS planted, count(*) AS rows, 1::BIGINT AS clusters, 1::BIGINT AS groups_of_cluster FROM orders GROUP BY 1"


def _recovered(spark, folder, model, params, across=_ACROSS):
    rows = _grouped(spark, folder, across)
    ready = fit_features(rows, ["x", "y"]).apply(rows, training=True)
    fitted = fit_model(model, parameters(model, params), ready, ready.count(), 42)
    cells = fitted.predict(ready).groupBy("planted", "prediction").agg(F.count(F.lit(1)).alias("n"))
    shared = cells.groupBy("prediction").agg(F.count(F.lit(1)).alias("groups_of_cluster"))
    joined = cells.join(shared, "prediction")
    return joined.groupBy("planted").agg(
        F.sum("n").alias("rows"), F.count(F.lit(1)).alias("clusters"), F.max("groups_of_cluster").alias("groups_of_cluster")
    )


@query(_GROUPS)
def kmeans(spark, folder):
    return _recovered(spark, folder, "kmeans", {})


@query(_GROUPS)
def agglomerative_ward(spark, folder):
    return _recovered(spark, folder, "agglomerative_clustering", {})


@query(_GROUPS)
def agglomerative_average(spark, folder):
    return _recovered(spark, folder, "agglomerative_clustering", {"linkage": "average"})


@query(_GROUPS)
def agglomerative_complete(spark, folder):
    return _recovered(spark, folder, "agglomerative_clustering", {"linkage": "complete"})


@query(_GROUPS)
def agglomerative_single(spark, folder):
    return _recovered(spark, folder, "agglomerative_clustering", {"linkage": "single"})


@query(_GROUPS)
def agglomerative_exact(spark, folder):
    """The different rows themselves are merged: 105 of them, however many orders there are."""
    return _recovered(spark, folder, "agglomerative_clustering", {"method": "exact"}, "(o_orderkey % 3) * 100 + o_custkey % 7 AS x")


@query(_GROUPS)
def agglomerative_single_exact(spark, folder):
    """Every order is a different row; all of them are merged."""
    return _recovered(spark, folder, "agglomerative_clustering", {"linkage": "single", "method": "exact"})


@query("""
WITH prices AS (SELECT DISTINCT o_totalprice AS x FROM orders), gaps AS (SELECT x, x - lag(x) OVER (ORDER BY x) AS gap FROM prices),
cuts AS (SELECT x FROM gaps ORDER BY gap DESC NULLS LAST, x DESC LIMIT 4)
SELECT o_orderkey, (SELECT count(*) FROM cuts WHERE cuts.x <= o_totalprice)::INT AS cluster FROM orders
""")
def cut_at_largest_gaps(spark, folder):
    """On one coordinate single linkage cuts at the largest gaps."""
    orders = table(spark, folder, "orders").select("o_orderkey", F.array("o_totalprice").alias("x"))
    return orders.join(single_linkage(orders, 5), "x").select("o_orderkey", "cluster")


@query(_TEST_CONFUSION)
def custom_model(spark, folder):
    """A caller's estimator, on the same split and features as the built-in ones."""
    model = CustomModel("bayes", "classification", lambda p: NaiveBayes(modelType="gaussian", smoothing=p["smoothing"]), {"smoothing": 1.0})
    return _confusion(spark, folder, ModelRequest(model))


@query(
    " UNION ALL ".join(
        f"SELECT '{name}' AS model, count(*) AS rows_used, 1.0::DOUBLE AS rand, TRUE AS apart, {figures}::BIGINT AS metrics FROM orders"
        for name, figures in (("K-Means", 6), ("Agglomerative Clustering", 5))
    )
)
def compared_clusterings(spark, folder):
    """Two clusterings of all orders, end to end, with every score on every row."""
    rows = _grouped(spark, folder)
    run = compare_models(rows, "planted", ["kmeans", "agglomerative_clustering"], columns=["x", "y"], key=["o_orderkey"])
    found = [
        (m.name, m.rows_used, m.metrics["adjusted_rand_index"], m.metrics["squared_silhouette_score"] > 0.99 and m.metrics["silhouette_score"] > 0.9 and m.metrics["davies_bouldin_score"] < 0.2, len(m.metrics))
        for m in run.models
    ]
    return spark.createDataFrame(found, "model string, rows_used bigint, rand double, apart boolean, metrics bigint")


@query(
    "SELECT * FROM (VALUES ('Random Forest'), ('Random Forest (2)')) AS m(model), (SELECT 5::BIGINT AS metrics, count(*) AS rows_used FROM part)"
)
def one_model_twice(spark, folder):
    """Two runs of one model with different parameters keep their figures apart."""
    parts = table(spark, folder, "part").selectExpr("p_partkey", "p_partkey % 1000 AS step", "p_retailprice")
    runs = [ModelRequest("random_forest", {"n_estimators": 10, "max_depth": depth}) for depth in (2, 8)]
    run = compare_models(parts, "p_retailprice", runs, key=["p_partkey"])
    figures = run.metrics().groupBy("model").agg(F.count("value").alias("metrics"))
    return figures.withColumn("rows_used", F.lit(run.models[0].rows_used).cast("bigint"))
