from __future__ import annotations

import math
import random

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from quillframe import CustomModel, ModelRequest, TableError, compare_models
from quillframe.operators import metrics as M, models as MO
from quillframe.operators import boxes, silhouette as silhouette_blocks
from quillframe.operators.silhouette import euclidean_silhouette
from quillframe.operators.agglomerative import Agglomerative, merge
from quillframe.operators.comparison import mark_best, relative_bars
from quillframe.operators.features import FEATURES, RARE, decode_label, encode_label, fit_features, label_order
from quillframe.plans import compare
from quillframe.plans.compare import check_requests
from quillframe.plans.pipeline import run_steps
from quillframe.sources.workspace import Workspace
from quillframe.streaming import clean_stream


def test_weighted_scores_with_labels_on_one_side_only(spark):
    chance = random.Random(3)
    pairs = [(chance.choice("abc"), chance.choice("abx")) for _ in range(300)]
    found = M.classification_metrics(spark.createDataFrame(pairs, "a string, p string"), "a", "p").first()
    labels = sorted({v for pair in pairs for v in pair})
    n = len(pairs)
    totals = {"precision": 0.0, "recall": 0.0, "f1_score": 0.0}
    for label in labels:
        hits = sum(a == p == label for a, p in pairs)
        support, called = sum(a == label for a, _ in pairs), sum(p == label for _, p in pairs)
        precision, recall = hits / called if called else 0.0, hits / support if support else 0.0
        f1 = 2 * precision * recall / (precision + recall) if precision + recall else 0.0
        for name, value in (("precision", precision), ("recall", recall), ("f1_score", f1)):
            totals[name] += value * support / n
    for name, value in totals.items():
        assert math.isclose(found[name], value, rel_tol=1e-12)
    assert math.isclose(found["accuracy"], sum(a == p for a, p in pairs) / n)
    matrix = M.confusion_matrix(spark.createDataFrame(pairs, "a string, p string"), "a", "p")
    assert matrix.count() == len(labels) ** 2 and matrix.agg(F.sum("n")).first()[0] == n


def test_r2_without_spread(spark):
    flat = spark.createDataFrame([(2.0, 2.0), (2.0, 2.0)], "a double, p double")
    assert M.r2(flat, "a", "p").first()[0] == 1.0
    assert M.r2(flat.withColumn("p", F.lit(3.0)), "a", "p").first()[0] == 0.0


def blobs(spark, n=240, far=10.0, seed=1):
    rng = np.random.default_rng(seed)
    rows = [(int(i), float(rng.normal() + far * (i % 3)), float(rng.normal() + far * (i % 3 == 1)), int(i % 3)) for i in range(n)]
    return spark.createDataFrame(rows, "id long, x double, y double, k int")


def brute_scores(df):
    pdf = df.toPandas()
    x, k = pdf[["x", "y"]].to_numpy(), pdf["k"].to_numpy()
    gaps = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    values = []
    for i in range(len(x)):
        same = (k == k[i]) & (np.arange(len(x)) != i)
        if not same.any():
            values.append(0.0)
            continue
        a = gaps[i, same].mean()
        b = min(gaps[i, k == other].mean() for other in set(k) - {k[i]})
        values.append((b - a) / max(a, b))
    centres = {c: x[k == c].mean(0) for c in set(k)}
    within = sum(((x[k == c] - m) ** 2).sum() for c, m in centres.items())
    between = sum((k == c).sum() * ((m - x.mean(0)) ** 2).sum() for c, m in centres.items())
    scatter = {c: np.sqrt(((x[k == c] - m) ** 2).sum(1)).mean() for c, m in centres.items()}
    worst = [
        max((scatter[c] + scatter[o]) / np.linalg.norm(centres[c] - centres[o]) for o in centres if o != c) for c in centres
    ]
    n, count = len(x), len(centres)
    return np.mean(values), between * (n - count) / (within * (count - 1)), np.mean(worst), within


def test_clustering_scores(spark):
    df = blobs(spark, 120, 3.0).withColumn("k", F.when(F.col("id") == 7, 9).otherwise(F.col("k")))  # one cluster of one row
    silhouette, ch, db, within = brute_scores(df)
    features = ["x", "y"]
    assert math.isclose(M.silhouette(df, features, "k").first()[0], silhouette, rel_tol=1e-6)
    assert math.isclose(M.calinski_harabasz(df, features, "k").first()[0], ch, rel_tol=1e-9)
    assert math.isclose(M.davies_bouldin(df, features, "k").first()[0], db, rel_tol=1e-9)
    assert math.isclose(M.inertia(df, features, "k").first()[0], within, rel_tol=1e-9)


def test_scores_without_two_clusters_are_missing(spark):
    for label in (F.lit(1), F.col("id")):
        df = blobs(spark, 20).withColumn("k", label)
        for score in (M.silhouette, M.calinski_harabasz, M.davies_bouldin):
            assert score(df, ["x", "y"], "k").first()[0] is None
        assert not M.cluster_count(df, "k").first()["scorable"]


def test_rand_index(spark):
    df = blobs(spark)
    renamed = df.withColumn("other", (F.col("k") + 1) % 3)
    assert M.adjusted_rand_index(renamed, "k", "other").first()[0] == 1.0
    assert M.adjusted_rand_index(df.withColumn("one", F.lit(1)), "k", "one").first()[0] == 0.0


def test_calinski_harabasz_far_from_the_origin(spark):
    df = blobs(spark, 120, 3.0)
    moved = df.withColumn("x", F.col("x") + 1e7)
    near, far = (M.calinski_harabasz(t, ["x", "y"], "k").first()[0] for t in (df, moved))
    assert math.isclose(near, far, rel_tol=1e-6)


def test_full_matrix_refuses_too_many_labels(spark):
    df = spark.range(M.MAX_LABELS + 1).select(F.col("id").alias("a"), F.col("id").alias("p"))
    with pytest.raises(Exception, match="too many labels"):
        M.confusion_matrix(df, "a", "p").count()
    assert M.confusion_counts(df, "a", "p").count() == M.MAX_LABELS + 1


def block_silhouette(x, k):
    """The mean silhouette of all rows, by numpy over stripes of them."""
    names, codes, sizes = np.unique(k, return_inverse=True, return_counts=True)
    order = np.argsort(codes, kind="stable")
    starts = np.cumsum(sizes) - sizes
    total = 0.0
    for at in range(0, len(x), 500):
        part, squares = x[at : at + 500], (x**2).sum(1)
        gaps = np.sqrt(np.maximum(squares[at : at + 500, None] + squares[order] - 2 * part @ x[order].T, 0))
        sums, own = np.add.reduceat(gaps, starts, axis=1), codes[at : at + 500]
        rows = np.arange(len(own))
        a = sums[rows, own] / np.maximum(sizes[own] - 1, 1)
        means = sums / sizes
        means[rows, own] = np.inf
        b = means.min(1)
        total += np.where(sizes[own] == 1, 0, (b - a) / np.maximum(np.maximum(a, b), 1e-300)).sum()
    return total / len(x)


def test_silhouette_of_fifty_thousand_rows(spark):
    draw = np.random.default_rng(3)
    n = 50_000
    k = np.minimum(draw.integers(0, 40, n), draw.integers(0, 40, n))  # clusters of very different sizes
    k[:2] = 77, 78  # two of one row
    x = draw.normal(size=(n, 2)) + 4 * draw.normal(size=(80, 2))[k]
    df = spark.createDataFrame(pd.DataFrame({"x": x[:, 0], "y": x[:, 1], "k": k})).repartition(6)
    expected = block_silhouette(x, k)
    assert math.isclose(M.silhouette(df, ["x", "y"], "k").first()[0], expected, rel_tol=1e-7)
    part = M.silhouette(df, ["x", "y"], "k", rows=10_000).first()[0]
    assert abs(part - expected) < 0.01


def test_silhouette_in_many_small_blocks(spark):
    draw = np.random.default_rng(4)
    for width, clusters in ((12, 5), (2, 150)):
        k = draw.integers(0, clusters, 400)
        x = np.round(draw.normal(size=(400, width)) + 3 * draw.normal(size=(clusters, width))[k], 1)
        df = spark.createDataFrame([(row.tolist(), str(c)) for row, c in zip(x, k)] + [([0.0] * width, None)], "x array<double>, label string")
        points = df.where("label IS NOT NULL")
        score = euclidean_silhouette(points, M._cluster_moments(points), None, block_rows=16)
        assert math.isclose(spark.range(1).select(score).first()[0], block_silhouette(x, k), rel_tol=1e-6)
    drawn = [M.silhouette(part, "x", "label", rows=100).first()[0] for part in (df, df.repartition(7))]
    assert math.isclose(*drawn, rel_tol=1e-9)  # the same rows, however the table is cut


def test_features(spark):
    rows = [(i, None if i == 3 else float(i), "ab"[i % 2] if i % 5 else None, i % 2 == 0, None) for i in range(20)]
    df = spark.createDataFrame(rows, "id long, x double, s string, b boolean, empty string")
    plan = fit_features(df, ["x", "s", "b", "empty"])
    assert plan.names == ["x", "b", "s=a", "s=b"]  # the column without values is left out
    ready = plan.apply(df, training=True).orderBy("id").select(vector_to_array(FEATURES).alias("v")).collect()
    matrix = np.array([r["v"] for r in ready])
    filled = df.orderBy("id").toPandas()["x"].fillna(df.toPandas()["x"].median())
    assert np.allclose(matrix[:, 0], (filled - filled.mean()) / filled.std(ddof=0))
    assert np.allclose(matrix[:, 1].mean(), 0) and set(matrix[:, 2:].sum(1)) == {1.0}
    unseen = spark.createDataFrame([(1, 0.0, "zzz", True, None)], df.schema)
    assert plan.apply(unseen).select(vector_to_array(FEATURES)[2] + vector_to_array(FEATURES)[3]).first()[0] == 0.0
    with pytest.raises(TableError):
        fit_features(df, ["empty"])


def test_more_than_fifty_categories(spark):
    counts = {f"c{i:02d}": 100 - i for i in range(60)}
    rows = [(name,) for name, n in counts.items() for _ in range(n)]
    train = spark.createDataFrame(rows, "s string")
    plan = fit_features(train, ["s"])
    assert len(plan.names) == 50 and plan.names[-1] == f"s={RARE}" and "s=c48" in plan.names and "s=c49" not in plan.names
    new = spark.createDataFrame([(0, "c00"), (1, "c55"), (2, "new")], "id long, s string")
    vectors = [np.array(r[0]) for r in plan.apply(new).orderBy("id").select(vector_to_array(FEATURES)).collect()]
    assert vectors[0][0] == 1 and vectors[1][-1] == 1 and vectors[2].sum() == 0 and vectors[1].sum() == 1


def naive_merge(points, weights, clusters, linkage):
    groups = [[(np.array(p, float), w)] for p, w in zip(points, weights)]

    def gap(a, b):
        pairs = [(np.linalg.norm(p - q), v * w) for p, v in a for q, w in b]
        if linkage == "single":
            return min(d for d, _ in pairs)
        if linkage == "complete":
            return max(d for d, _ in pairs)
        if linkage == "average":
            return sum(d * w for d, w in pairs) / sum(w for _, w in pairs)
        wa, wb = sum(w for _, w in a), sum(w for _, w in b)
        ca, cb = sum(p * w for p, w in a) / wa, sum(p * w for p, w in b) / wb
        return wa * wb / (wa + wb) * ((ca - cb) ** 2).sum()

    while len(groups) > clusters:
        i, j = min(((i, j) for i in range(len(groups)) for j in range(i)), key=lambda ij: gap(groups[ij[0]], groups[ij[1]]))
        groups[j] += groups.pop(i)
    return sorted(sorted(tuple(p) for p, _ in g) for g in groups)


@pytest.mark.parametrize("linkage", ["ward", "complete", "average", "single"])
def test_merging_equals_the_definition(linkage):
    rng = np.random.default_rng(4)
    points, weights = rng.normal(size=(25, 2)), rng.integers(1, 6, 25)
    found = merge(points, weights, 4, linkage)
    groups = sorted(sorted(tuple(p) for p in points[found == c]) for c in range(4))
    assert groups == naive_merge(points, weights, 4, linkage)


def test_agglomerative_with_few_and_many_points(spark):
    df = blobs(spark, 600)
    copies = df.union(df.where("id < 300"))  # copies count as weight
    ready = fit_features(copies, ["x", "y"]).apply(copies, training=True)
    for model in (Agglomerative(3), Agglomerative(3, groups=40)):
        labelled = model.fit(ready)(ready)
        assert labelled.count() == 900
        assert M.adjusted_rand_index(labelled, "k", "prediction").first()[0] > 0.99
    with pytest.raises(TableError):
        Agglomerative(3, "nearest").fit(ready)


def test_nonnegative_least_squares(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 3))
    y = 2 * x[:, 0] - 1.5 * x[:, 1] + 0.5 * x[:, 2] + 4 + 0.01 * rng.normal(size=300)
    df = spark.createDataFrame([(float(a), float(b), float(c), float(t)) for (a, b, c), t in zip(x, y)], "a double, b double, c double, label double")
    ready = fit_features(df, ["a", "b", "c"]).apply(df, training=True)
    fitted = MO.fit_model("linear_regression", MO.parameters("linear_regression", {"positive": True}), ready, 300, 1)
    found = M.regression_metrics(fitted.predict(ready), "label", "prediction").first()["mse"]
    centred = x - x.mean(0)
    best = min(
        float(np.mean((y - y.mean() - centred[:, keep] @ w) ** 2))
        for keep in ([0], [2], [0, 2])
        if (w := np.linalg.lstsq(centred[:, keep], y - y.mean(), rcond=None)[0]).min() >= 0
    )
    assert math.isclose(found, best, rel_tol=1e-6)


@pytest.mark.parametrize(
    "model, params",
    [
        ("decision_tree", {"max_depth": 31}), ("decision_tree", {"splitter": "random"}), ("decision_tree", {"min_samples_split": 3}),
        ("decision_tree", {"colour": 1}), ("random_forest", {"criterion": "poisson"}), ("logistic_regression", {"class_weight": "heavy"}),
        ("kmeans", {"n_clusters": 1}), ("kmeans", {"n_clusters": 60}), ("agglomerative_clustering", {"n_clusters": 0}),
    ],
)
def test_parameters_that_cannot_be_met(spark, model, params):
    df = blobs(spark, 60).withColumn("label", F.col("k").cast("double"))
    ready = fit_features(df, ["x", "y"]).apply(df, training=True)
    with pytest.raises(TableError):
        MO.fit_model(model, MO.parameters(model, params), ready, 60, 1)


def test_tree_variants_learn_a_planted_rule(spark):
    rng = np.random.default_rng(2)
    rows = [(float(a), float(b), "in" if a > 0.5 and b < 0.3 else "out") for a, b in rng.random((1000, 2))]
    df = spark.createDataFrame(rows, "x double, y double, cls string")
    for params in ({}, {"criterion": "log_loss", "max_features": "sqrt"}, {"max_depth": 30}):
        run = compare_models(df, "cls", [ModelRequest("decision_tree", params)])
        assert run.models[0].metrics["accuracy"] > 0.95


def test_requests_of_different_tasks():
    both = [ModelRequest("decision_tree"), ModelRequest("kmeans")]
    for requests, task in ((both, "classification"), ([], "regression"), ([ModelRequest("decision_tree")], "unknown"), ([ModelRequest("magic")], "regression")):
        with pytest.raises(TableError):
            check_requests(requests, task)
    assert check_requests([ModelRequest("kmeans")], "unknown") == "clustering"
    own = CustomModel("mine", "regression", lambda p: None)
    with pytest.raises(TableError):
        check_requests([ModelRequest(own)], "classification")


def test_custom_models_are_checked(spark):
    df = blobs(spark, 60).withColumn("label", F.col("x"))
    ready = fit_features(df, ["x", "y"]).apply(df, training=True)
    with pytest.raises(TableError):
        MO.fit_custom(CustomModel("none", "regression", lambda p: None), {}, ready)
    seen = {}

    def build_model(params):
        seen.update(params)
        return GeneralizedLinearRegression(maxIter=params["rounds"])

    fitted, params = MO.fit_custom(CustomModel("glm", "regression", build_model, {"rounds": 5, "other": 1}), {"rounds": 3}, ready)
    assert seen == params == {"rounds": 3, "other": 1}
    assert M.r2(fitted.predict(ready), "label", "prediction").first()[0] > 0.99


def test_comparison_of_regressions(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i), float(a), "uv"[i % 2], None if i % 50 == 0 else float(3 * a + (i % 2))) for i, a in enumerate(rng.normal(size=400))]
    df = spark.createDataFrame(rows, "id long, x double, s string, y double")
    run = compare_models(df, "y", ["linear_regression", ModelRequest("random_forest", {"n_estimators": 5})], key=["id"], train_pct=60)
    linear = run.models[0]
    assert run.task == "regression" and (linear.train_rows, linear.test_rows) == (235, 157)
    assert set(linear.metrics) == {"mae", "mse", "rmse", "r2", "training_r2"} and linear.metrics["r2"] > 0.999
    assert linear.chart.count() == 80 and run.side_by_side().columns == ["metric", "Linear Regression", "Random Forest"]
    again = compare_models(df.repartition(5), "y", ["linear_regression"], key=["id"], train_pct=60)
    assert again.models[0].metrics["mae"] == linear.metrics["mae"]


def test_comparison_of_clusterings(spark):
    df = blobs(spark, 300)
    run = compare_models(df, "k", [ModelRequest("kmeans", {"n_init": 2}), "agglomerative_clustering"], columns=["x", "y"], key=["id"])
    assert run.task == "clustering"
    for model in run.models:
        assert model.metrics["adjusted_rand_index"] == 1.0 and sum(c["size"] for c in model.chart.collect()) == 300
        assert {"silhouette_score", "squared_silhouette_score", "calinski_harabasz_score", "davies_bouldin_score"} <= set(model.metrics)
    assert "inertia" in run.models[0].metrics and "inertia" not in run.models[1].metrics


def test_comparison_requests_that_do_not_fit(spark):
    df = blobs(spark, 30)
    for arguments in ({"target": "no"}, {"train_pct": 0}, {"requests": []}, {"mode": "turbo"}, {"columns": ["k"]}):
        with pytest.raises(TableError):
            compare_models(**{"df": df, "target": "k", "requests": ["kmeans"], **arguments})
    with pytest.raises(TableError):
        compare_models(df.limit(9), "k", ["kmeans"], columns=["x"])


def test_very_many_classes_are_numbered(spark):
    df = spark.range(10_050).select(F.format_string("%05d", "id").alias("c"), F.col("id").cast("double").alias("n"))
    order = label_order(df, "c")
    numbered = encode_label(df, "c", order)
    assert numbered.where("label <> n").count() == 0
    assert decode_label(numbered, "label", order, "back").where("back <> c").count() == 0
    strange = spark.createDataFrame([("x",), (None,)], "c string")
    assert [r["label"] for r in encode_label(strange, "c", order).collect()] == [None, None]


def test_two_runs_of_one_model_are_both_kept(spark):
    df = spark.range(300).select("id", (F.col("id") % 50).alias("x"), ((F.col("id") % 50) * 2.5).alias("y"))
    few = [ModelRequest("random_forest", {"n_estimators": 3, "max_depth": depth, "max_features": "auto"}) for depth in (1, 9)]
    run = compare_models(df, "y", few, columns=["x"], task="regression")
    table = {r["metric"]: r for r in run.side_by_side().collect()}
    assert run.side_by_side().columns == ["metric", "Random Forest", "Random Forest (2)"]
    assert table["r2"]["Random Forest"] < table["r2"]["Random Forest (2)"]


def test_split_without_key_does_not_depend_on_partitions(spark):
    df = spark.range(400).select((F.col("id") % 37).cast("double").alias("x"), F.hash("id").cast("double").alias("z"), (F.hash("id") % 5).cast("double").alias("y"))
    runs = [compare_models(part, "y", ["linear_regression"], task="regression").models[0].metrics for part in (df.repartition(2), df.repartition(5))]
    assert runs[0] == runs[1]


def test_squared_silhouette_against_all_pairs(spark):
    df = blobs(spark, 60)
    rows = df.select("x", "y", "k").collect()
    points, groups = np.array([(r["x"], r["y"]) for r in rows]), np.array([r["k"] for r in rows])
    apart = ((points[:, None] - points[None]) ** 2).sum(2)
    values = []
    for i, g in enumerate(groups):
        own = apart[i][groups == g].sum() / ((groups == g).sum() - 1)
        other = min(apart[i][groups == h].mean() for h in set(groups.tolist()) - {g})
        values.append((other - own) / max(own, other))
    ready = fit_features(df, ["x", "y"])
    held = df.select(array_to_vector(F.array(F.col("x").cast("double"), F.col("y").cast("double"))).alias("features"), "k")
    assert ready and abs(M.squared_silhouette(held, "features", "k").first()[0] - np.mean(values)) < 1e-6


def test_other_solvers_are_refused(spark):
    df = spark.createDataFrame([(array, float(i % 2)) for i, array in enumerate([[0.0], [1.0]] * 10)], "a array<double>, label double").select(array_to_vector("a").alias(FEATURES), "label")
    with pytest.raises(TableError, match="solver"):
        MO.fit_model("logistic_regression", MO.parameters("logistic_regression", {"solver": "saga"}), df, 20, 1)


def test_unlimited_depth_is_refused(spark):
    df = spark.range(40).select("id", (F.col("id") % 10).alias("x"), (F.col("id") % 2).cast("string").alias("y"))
    with pytest.raises(TableError):
        compare_models(df, "y", [ModelRequest("decision_tree", {"max_depth": None})], columns=["x"])


def test_bars_and_best(spark):
    rows = [("a", "mae", 5.0), ("b", "mae", 10.0), ("a", "r2", 0.001), ("b", "r2", -0.5), ("a", "inertia", 0.0)]
    df = spark.createDataFrame(rows, "model string, metric string, value double")
    bars = {(r["model"], r["metric"]): r["bar"] for r in relative_bars(df).collect()}
    assert bars == {("a", "mae"): 50.0, ("b", "mae"): 100.0, ("a", "r2"): 1.0, ("b", "r2"): 50.0, ("a", "inertia"): 1.0}
    best = {(r["model"], r["metric"]) for r in mark_best(df).where("is_best").collect()}
    assert best == {("a", "mae"), ("a", "r2"), ("a", "inertia")}


def test_workspace(spark, tmp_path):
    space = Workspace(spark, str(tmp_path / "space"))
    assert space.listing().count() == 0 and space.history().count() == 0
    df = blobs(spark, 60)
    first = space.save_copy(df, "blobs")
    second = space.save_copy(run_steps(space.open_copy(first), [("drop_columns", {"columns": ["y"]})]), "slim", [first], "y dropped")
    assert [r["name"] for r in space.listing().collect()] == ["slim", "blobs"]
    run = compare_models(df, "k", [ModelRequest("kmeans", {"n_init": 1})], columns=["x", "y"], key=["id"], dataset_id=second)
    space.record(run)
    entry = space.history().first()
    assert entry["models"][0]["metrics"]["adjusted_rand_index"] == 1.0 and entry["rows_available"] == 60
    request = space.replay(run.id)
    assert request["columns"] == ["x", "k"] and request["models"][0][0] == "kmeans" and request["models"][0][1]["n_init"] == 1
    assert space.open_copy(second).columns == ["id", "x", "k"]
    for wrong in (lambda: space.open_copy("no"), lambda: space.replay("no")):
        with pytest.raises(TableError):
            wrong()


def test_row_local_steps_run_on_a_stream(spark, folder, tmp_path):
    table = f"{folder}/customer.parquet"
    schema = spark.read.parquet(table).schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "customer.parquet").parquet(folder)
    steps = [
        ("replace", {"column": "c_mktsegment", "find": "BUILDING", "replace": "BUILD"}),
        ("drop_columns", {"columns": ["c_name"]}),
        ("fill_missing", {"columns": ["c_acctbal"], "method": "constant", "value": 0}),
    ]
    run = clean_stream(stream, steps).writeStream.format("memory").queryName("cleaned").option("checkpointLocation", str(tmp_path)).start()
    run.processAllAvailable()
    run.stop()
    expected = run_steps(spark.read.parquet(table), steps)
    assert spark.table("cleaned").exceptAll(expected).count() == 0 and spark.table("cleaned").count() == expected.count()
    with pytest.raises(TableError):
        clean_stream(stream, [("normalize", {"columns": ["c_acctbal"]})])


def test_blocks_are_shuffled_once_for_each_group_they_meet(spark):
    """Not once for each block: with 60 blocks against 60, 3,600 times."""
    blocks = spark.range(60).select(((F.col("id") / 8).cast("long") * (1 << 32) + F.col("id") % 8).alias("block"))
    data = blocks.select("block", *[F.array(F.lit(1)).alias(name) for name in ("codes", "sizes", "x")])
    pairs = blocks.withColumnRenamed("block", "q").crossJoin(blocks).withColumn("wanted", F.array(F.lit(1)))
    for together, most in ((16, 4), (3, 23)):
        sides = silhouette_blocks._gathered(pairs, data, data, together, 8)
        assert [side.count() for side in sides] == [60 * most, 60 * most]
        sizes = [side.groupBy("g", "s").count().agg(F.max("count")).first()[0] for side in sides]
        assert max(sizes) <= together and sides[0].select(F.sum(F.size("asks"))).first()[0] == 3600


def test_a_forest_answers_on_all_cores(spark):
    rows = spark.range(200).select((F.col("id") % 20).cast("double").alias("x"), (F.col("id") % 20).cast("double").alias("label")).coalesce(1)
    plan = fit_features(rows, ["x"])
    ready = plan.apply(rows, training=True)
    fitted = MO.fit_model("random_forest", MO.parameters("random_forest", {"n_estimators": 3, "max_depth": 5}), ready, 200, 42)
    answers = fitted.predict(ready)
    assert answers.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert answers.count() == 200 and answers.agg(F.max(F.abs(F.col("label") - F.col("prediction")))).first()[0] < 2


def test_starts_of_kmeans_keep_the_decoded_rows(spark, monkeypatch):
    """The rows are cached once, and what each start is given is not itself a cached table, so that k-means keeps them decoded."""
    rows = spark.range(300).select((F.col("id") % 3 * 100 + F.col("id") % 7).cast("double").alias("x"))
    ready = fit_features(rows, ["x"]).apply(rows, training=True)
    given, fit = [], MO.KMeans.fit

    def watched(model, table, *rest):
        below = table.select(FEATURES)._jdf.queryExecution().withCachedData().toString()
        given.append((table.storageLevel.useMemory, "InMemoryRelation" in below))
        return fit(model, table, *rest)

    monkeypatch.setattr(MO.KMeans, "fit", watched)
    fitted = MO.fit_model("kmeans", MO.parameters("kmeans", {"n_init": 2}), ready, 300, 42)
    assert given == [(False, True)] * 2
    sizes = fitted.predict(ready).groupBy("prediction").count().collect()
    assert sorted(row["count"] for row in sizes) == [100] * 3


def test_groups_of_blocks_are_dealt_over_the_cores(spark):
    """Not over as few tasks as their bytes call for: what takes long are the distances."""
    rows = spark.range(4000).select((F.col("id") % 2).alias("label"), F.array(F.hash("id") % 1000 / 10 + F.col("id") % 2 * 500).alias("x"))
    dealt, repartition = [], type(rows).repartition

    def watched(table, number, *columns):
        dealt.append((number, columns))
        return repartition(table, number, *columns)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(type(rows), "repartition", watched)
        score = euclidean_silhouette(rows, M._cluster_moments(rows), 1000, block_rows=64)
    cores = spark.sparkContext.defaultParallelism
    assert [columns for _, columns in dealt] == [("g", "s")] * 2 and {number for number, _ in dealt} == {4 * cores}
    x, k = (np.array(c) for c in zip(*[(row["x"], row["label"]) for row in rows.collect()]))
    assert abs(spark.range(1).select(score).first()[0] - block_silhouette(x, k)) < 0.01


@pytest.mark.parametrize("width", [1, 3, 8, 12])
def test_sums_of_distances_against_numpy(width):
    """Also where rows are cut into stripes, and the same to the last bit as the differences of all pairs."""
    chance = np.random.default_rng(width)
    a, b, starts = chance.normal(size=(100, width)), chance.normal(size=(2048, width)), np.array([0, 1, 700])
    expected = np.add.reduceat(np.sqrt(((a[:, None] - b[None]) ** 2).sum(axis=2)), starts, axis=1)
    assert np.allclose(silhouette_blocks._totals(a, b, starts), expected, rtol=1e-9)
    if width <= 8:
        assert np.array_equal(silhouette_blocks._totals(a, b, starts), np.add.reduceat(silhouette_blocks._distances(a, b), starts, axis=1))


def test_compared_clusterings_take_the_silhouette_of_all_rows(spark):
    """Not that of 10,000 drawn ones."""
    draw = np.random.default_rng(6)
    k = draw.integers(0, 3, 11_000)
    x = draw.normal(size=(11_000, 2)) + 2.5 * np.array([[0, 0], [1, 1], [0, 2]])[k]
    df = spark.createDataFrame(pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "prediction": k}))
    labelled = df.select(array_to_vector(F.array("a", "b")).alias(FEATURES), "prediction", F.lit(None).cast("string").alias("target"))
    figures = compare._clustering_figures(labelled, "target", MO.Fitted(lambda table: table), custom=True)
    assert abs(figures["silhouette_score"] - block_silhouette(x, k)) <= 0.51e-5


def _cut(x, code, weight, most):
    """Leaves of each code, and the trees over them."""
    parts = []
    for c in np.unique(code):
        own = np.flatnonzero(code == c)
        at, starts = boxes.leaves(x[own], most)
        parts += [(c, x[own[rows]], weight[own[rows]]) for rows in np.split(at, starts[1:])]
    low, high = (np.array([side(part, axis=0) for _, part, _ in parts]) for side in (np.min, np.max))
    grid = np.array([boxes.grid_weights(part, share, *box) for (_, part, share), *box in zip(parts, low, high)])
    return parts, boxes.forest(np.array([c for c, _, _ in parts]), low, high, grid)


@pytest.mark.parametrize("width", [1, 2, 3])
@pytest.mark.parametrize("kind", ["even", "stretched", "outliers", "rounded"])
def test_sums_of_distances_by_boxes_against_numpy(width, kind):
    chance = np.random.default_rng(width)
    n = 6000
    code, weight, x = chance.integers(0, 3, n), chance.integers(1, 5, n).astype(float), chance.normal(size=(n, width))
    if kind == "stretched":
        x *= np.exp(4 * chance.normal(size=(n, 1)))
    elif kind == "outliers":
        x[:5] = 1e6 * chance.normal(size=(5, width))
    elif kind == "rounded":
        x = np.round(3 * x)
    x += 2.0 * code[:, None]
    parts, trees = _cut(x, code, weight, 40)
    some = np.r_[:5, chance.integers(0, n, 800)]
    found = boxes.distances_to(trees, x[some], np.array(list(trees.roots.values())), 40, lambda i: parts[i][1:])
    gaps = np.sqrt(((x[some][:, None] - x[None]) ** 2).sum(axis=2))
    for c in range(3):
        assert np.allclose(found[c], gaps[:, code == c] @ weight[code == c], rtol=1e-12 if width == 1 else 1e-7)


def test_few_distances_are_taken_point_by_point():
    chance = np.random.default_rng(8)
    n = 200_000
    x = chance.normal(size=(n, 2)) * np.exp(chance.normal(size=(n, 1)))
    parts, trees = _cut(x, np.zeros(n, int), np.ones(n), 256)
    asked = x[boxes.leaves(x, 10_000)[0][:10_000]]
    sizes = np.array([len(part) for _, part, _ in parts])
    met = [(len(rows) * sizes[trees.leaf[near]].sum(), len(rows) * len(far)) for rows, far, near in boxes.walk(trees, asked, np.array([0]), 256)]
    assert sum(points for points, _ in met) < 0.1 * n * len(asked) and sum(far for _, far in met) < 300 * len(asked)


@pytest.mark.parametrize("width", [1, 2, 3])
def test_silhouette_by_boxes_counts_equal_rows(spark, width):
    chance = np.random.default_rng(width)
    n = 1500
    k = chance.integers(0, 4, n)
    x = np.round(chance.normal(size=(n, width)) * 3 + k[:, None] * 4)
    x[k == 3] = 50.0  # a cluster of equal rows
    k[0] = 9
    df = spark.createDataFrame([(row.tolist(), str(c)) for row, c in zip(x, k)], "x array<double>, label string")
    score = euclidean_silhouette(df, M._cluster_moments(df), None, block_rows=32)
    assert math.isclose(spark.range(1).select(score).first()[0], block_silhouette(x, k), rel_tol=1e-6)


def test_chunks_hold_rows_of_one_cluster():
    """Also those of a cluster that goes on in the next batch; none is lost."""
    code = np.repeat([-5, 2, 3, 7], [3, 250, 1, 90])
    table = pa.table({"code": code, "x0": np.arange(len(code)) * 1.0, "weight": np.ones(len(code)), "key": code})
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr("pyspark.TaskContext.get", lambda: type("Task", (), {"partitionId": lambda self: 2})())
        written = [b.to_pylist()[0] for b in silhouette_blocks._chunks(1, 8, 64)(iter(table.to_batches(max_chunksize=50)))]
    assert [(row["g"] - (2 << 24), row["code"]) for row in written] == [*enumerate([-5, 2, 2, 2, 2, 3, 7, 7])]
    assert sorted(v for row in written for v in np.frombuffer(row["x"])) == list(range(len(code)))
    assert all(len(row["x"]) <= 64 * 8 and len(np.frombuffer(row["starts"], np.int64)) == len(row["low"]) // 8 for row in written)
