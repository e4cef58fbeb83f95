"""Metrics of predictions made by fixed rules, so that SQL can repeat them."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from checks.registry import query, table
from quillframe.operators import metrics as M

_CALLS = (
    "SELECT l_returnflag AS actual, CASE WHEN l_quantity > 40 THEN 'A' WHEN l_quantity > 25 THEN 'R' ELSE 'X' END AS predicted FROM lineitem"
)


def _calls(spark, folder):
    return table(spark, folder, "lineitem").selectExpr(
        "l_returnflag AS actual", "CASE WHEN l_quantity > 40 THEN 'A' WHEN l_quantity > 25 THEN 'R' ELSE 'X' END AS predicted"
    )


@query(
    f"WITH p AS ({_CALLS}), labels AS (SELECT actual AS k FROM p UNION SELECT predicted FROM p), "
    "c AS (SELECT k, (SELECT count(*) FROM p WHERE actual = k) AS s, (SELECT count(*) FROM p WHERE predicted = k) AS c, "
    "(SELECT count(*) FROM p WHERE actual = k AND predicted = k) AS h FROM labels), "
    "r AS (SELECT s, h, CASE WHEN c = 0 THEN 0 ELSE h::DOUBLE / c END AS pr, CASE WHEN s = 0 THEN 0 ELSE h::DOUBLE / s END AS re, "
    "CASE WHEN c + s = 0 THEN 0 ELSE 2.0::DOUBLE * h / (c + s) END AS f FROM c) "
    "SELECT round(sum(h)::DOUBLE / sum(s), 5) AS accuracy, round((sum(pr * s) / sum(s))::DOUBLE, 5) AS precision, "
    "round((sum(re * s) / sum(s))::DOUBLE, 5) AS recall, round((sum(f * s) / sum(s))::DOUBLE, 5) AS f1_score FROM r"
)
def classification_scores(spark, folder):
    scores = M.classification_metrics(_calls(spark, folder), "actual", "predicted")
    return scores.select(*[F.round(name, 5).alias(name) for name in scores.columns])


@query(f"WITH p AS ({_CALLS}) SELECT round(avg((actual = predicted)::INT), 5) AS accuracy FROM p")
def accuracy_alone(spark, folder):
    return M.accuracy(_calls(spark, folder), "actual", "predicted").select(F.round("accuracy", 5).alias("accuracy"))


@query(
    f"WITH p AS ({_CALLS}), labels AS (SELECT actual AS k FROM p UNION SELECT predicted FROM p), "
    "g AS (SELECT a.k AS actual, b.k AS predicted FROM labels a, labels b) "
    "SELECT g.actual, g.predicted, count(p.actual) AS n FROM g LEFT JOIN p ON p.actual = g.actual AND p.predicted = g.predicted GROUP BY 1, 2"
)
def confusion_matrix(spark, folder):
    return M.confusion_matrix(_calls(spark, folder), "actual", "predicted")


_GUESSES = "SELECT p_partkey, p_retailprice AS a, 900 + 0.09::DOUBLE * (p_partkey % 1000) + p_size AS p FROM part"


def _guesses(spark, folder):
    return table(spark, folder, "part").selectExpr(
        "p_partkey", "p_retailprice AS a", "900 + 0.09D * (p_partkey % 1000) + p_size AS p"
    )


@query(
    f"WITH g AS ({_GUESSES}), m AS (SELECT avg(a) AS c FROM g) SELECT round(avg(abs(a - p)), 5) AS mae, round(avg((a - p) * (a - p)), 5) AS mse, "
    "round(sqrt(avg((a - p) * (a - p))), 5) AS rmse, round(1 - sum((a - p) * (a - p)) / sum((a - c) * (a - c)), 5) AS r2 FROM g, m"
)
def regression_scores(spark, folder):
    scores = M.regression_metrics(_guesses(spark, folder), "a", "p")
    return scores.select(*[F.round(name, 5).alias(name) for name in scores.columns])


@query(f"WITH g AS ({_GUESSES}) SELECT p_partkey, a AS actual, round(p, 6) AS predicted FROM g ORDER BY p_partkey LIMIT 80")
def actual_and_predicted(spark, folder):
    pairs = M.actual_predicted_sample(_guesses(spark, folder), "a", "p", ["p_partkey"])
    return pairs.withColumn("predicted", F.round("predicted", 6))


_POINTS = "SELECT vec_id, vec_id % 3 AS c, embedding::DOUBLE[] AS e FROM embeddings"
_CENTRES = (
    f"WITH p AS ({_POINTS}), u AS (SELECT vec_id, c, unnest(e) AS v, generate_subscripts(e, 1) AS d FROM p), "
    "k AS (SELECT c, d, avg(v) AS m, count(*) AS n FROM u GROUP BY c, d)"
)


def _points(spark, folder):
    return table(spark, folder, "embeddings").selectExpr("vec_id", "vec_id % 3 AS c", "CAST(embedding AS ARRAY<DOUBLE>) AS e")


@query(
    f"WITH p AS ({_POINTS}), d AS (SELECT a.vec_id AS id, a.c AS own, b.c AS other, sum(list_distance(a.e, b.e)) AS total, "
    "count(*) AS n FROM p a, p b GROUP BY 1, 2, 3), "
    "i AS (SELECT id, total / (n - 1) AS inner_mean FROM d WHERE own = other), o AS (SELECT id, min(total / n) AS outer_mean FROM d WHERE own <> other GROUP BY id) "
    "SELECT round(avg((outer_mean - inner_mean) / greatest(outer_mean, inner_mean)), 5) AS silhouette_score FROM i JOIN o USING (id)"
)
def silhouette(spark, folder):
    return M.silhouette(_points(spark, folder), "e", "c").select(F.round("silhouette_score", 5).alias("silhouette_score"))


@query(
    f"WITH p AS ({_POINTS}), d AS (SELECT a.vec_id AS id, a.c AS own, b.c AS other, sum(power(list_distance(a.e, b.e), 2)) AS total, "
    "count(*) AS n FROM p a, p b GROUP BY 1, 2, 3), "
    "i AS (SELECT id, total / (n - 1) AS inner_mean FROM d WHERE own = other), o AS (SELECT id, min(total / n) AS outer_mean FROM d WHERE own <> other GROUP BY id) "
    "SELECT round(avg((outer_mean - inner_mean) / greatest(outer_mean, inner_mean)), 5) AS squared_silhouette_score FROM i JOIN o USING (id)"
)
def squared_silhouette(spark, folder):
    points = _points(spark, folder).select("c", array_to_vector("e").alias("features"))
    return M.squared_silhouette(points, "features", "c").select(F.round("squared_silhouette_score", 5).alias("squared_silhouette_score"))


@query(
    f"{_CENTRES}, g AS (SELECT d, avg(v) AS g FROM u GROUP BY d), "
    "b AS (SELECT sum(k.n * (m - g) * (m - g)) AS between_, count(DISTINCT c) AS k FROM k JOIN g USING (d)), "
    "w AS (SELECT sum((v - m) * (v - m)) AS within_, count(DISTINCT vec_id) AS n FROM u JOIN k USING (c, d)) "
    "SELECT round(between_ * (n - k) / (within_ * (k - 1)), 5) AS calinski_harabasz_score FROM b, w"
)
def calinski_harabasz(spark, folder):
    score = M.calinski_harabasz(_points(spark, folder), "e", "c")
    return score.select(F.round("calinski_harabasz_score", 5).alias("calinski_harabasz_score"))


@query(
    f"{_CENTRES}, far AS (SELECT vec_id, c, sqrt(sum((v - m) * (v - m))) AS away FROM u JOIN k USING (c, d) GROUP BY 1, 2), s AS (SELECT c, avg(away) AS scatter FROM far GROUP BY c), "
    "r AS (SELECT a.c AS c, b.c AS o, sqrt(sum((a.m - b.m) * (a.m - b.m))) AS apart FROM k a JOIN k b ON a.d = b.d AND a.c <> b.c GROUP BY 1, 2), "
    "x AS (SELECT r.c, max((s1.scatter + s2.scatter) / apart) AS worst FROM r JOIN s s1 ON s1.c = r.c JOIN s s2 ON s2.c = r.o GROUP BY 1) "
    "SELECT round(avg(worst), 5) AS davies_bouldin_score FROM x"
)
def davies_bouldin(spark, folder):
    score = M.davies_bouldin(_points(spark, folder), "e", "c")
    return score.select(F.round("davies_bouldin_score", 5).alias("davies_bouldin_score"))


_RAND_POINTS = "SELECT CASE WHEN l_linenumber = 3 THEN NULL ELSE l_returnflag END AS truth, l_orderkey % 4 AS c FROM lineitem"


@query(
    f"WITH p AS ({_RAND_POINTS}), cells AS (SELECT truth, c, count(*)::DOUBLE AS n FROM p GROUP BY 1, 2), "
    "a AS (SELECT sum(n) AS n FROM cells GROUP BY truth), b AS (SELECT sum(n) AS n FROM cells GROUP BY c), "
    "v AS (SELECT (SELECT sum(n * (n - 1) / 2) FROM cells) AS agreed, (SELECT sum(n * (n - 1) / 2) FROM a) AS t, "
    "(SELECT sum(n * (n - 1) / 2) FROM b) AS k, (SELECT sum(n) * (sum(n) - 1) / 2 FROM cells) AS total) "
    "SELECT round((agreed - t * k / total) / ((t + k) / 2 - t * k / total), 5) AS adjusted_rand_index FROM v"
)
def adjusted_rand_index(spark, folder):
    lines = table(spark, folder, "lineitem").selectExpr(
        "CASE WHEN l_linenumber = 3 THEN NULL ELSE l_returnflag END AS truth", "l_orderkey % 4 AS c"
    )
    return M.adjusted_rand_index(lines, "truth", "c").select(F.round("adjusted_rand_index", 5).alias("adjusted_rand_index"))


@query(f"{_CENTRES} SELECT round(sum((v - m) * (v - m)), 5) AS inertia FROM u JOIN k USING (c, d)")
def inertia(spark, folder):
    return M.inertia(_points(spark, folder), "e", "c").select(F.round("inertia", 5).alias("inertia"))


@query("SELECT o_orderkey % 7 AS cluster, count(*) AS size FROM orders GROUP BY 1")
def cluster_sizes(spark, folder):
    return M.cluster_sizes(table(spark, folder, "orders").selectExpr("o_orderkey % 7 AS c"), "c")


@query("SELECT count(DISTINCT o_orderkey % 7) AS clusters, count(*) AS rows, TRUE AS scorable FROM orders")
def cluster_count(spark, folder):
    return M.cluster_count(table(spark, folder, "orders").selectExpr("o_orderkey % 7 AS c"), "c")
