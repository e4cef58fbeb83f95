"""The six built-in models on ``pyspark.ml``, and the hook for a caller's own."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from typing import Any

import numpy as np
import pandas as pd
from pyspark import StorageLevel, TaskContext
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

from quillframe.errors import TableError
from quillframe.operators.agglomerative import GROUPS, Agglomerative
from quillframe.operators.features import FEATURES

LABEL = "label"
PREDICTION = "prediction"
WEIGHT = "_weight"
MAX_BINS = 256
NODE_MEMORY = 512  # megabytes of split statistics per pass over the rows; more saves passes on wide levels
MAX_DEPTH = 30  # the deepest tree that Spark trains
GRAM_BYTES = 128 << 20  # of the matrix of features by features that the driver solves for
TOGETHER = 16  # such matrices added up in one task


@dataclass(frozen=True)
class ModelSpec:
    name: str
    task: str
    defaults: Mapping[str, Any]


# The models on offer and their default parameters.
MODELS: dict[str, ModelSpec] = {
    "decision_tree": ModelSpec("Decision Tree", "classification", {
        "criterion": "auto", "splitter": "best", "max_depth": 8,
        "min_samples_split": 2, "min_samples_leaf": 1, "max_features": "auto",
    }),
    "logistic_regression": ModelSpec("Logistic Regression", "classification", {
        "C": 1.0, "max_iter": 500, "solver": "lbfgs", "class_weight": "none", "tol": 0.0001,
    }),
    "linear_regression": ModelSpec("Linear Regression", "regression", {
        "fit_intercept": True, "positive": False,
    }),
    "random_forest": ModelSpec("Random Forest", "regression", {
        "n_estimators": 120, "criterion": "auto", "max_depth": 12, "min_samples_split": 2,
        "min_samples_leaf": 1, "max_features": "sqrt", "bootstrap": True,
    }),
    "kmeans": ModelSpec("K-Means", "clustering", {
        "n_clusters": 3, "init": "k-means++", "n_init": 10, "max_iter": 300, "tol": 0.0001,
    }),
    "agglomerative_clustering": ModelSpec("Agglomerative Clustering", "clustering", {
        "n_clusters": 3, "linkage": "ward", "method": "grouped", "groups": GROUPS,
    }),
}

# The pair of models proposed for each task.
STARTER_PAIRS = {
    "classification": ("decision_tree", "logistic_regression"),
    "regression": ("linear_regression", "random_forest"),
    "clustering": ("kmeans", "agglomerative_clustering"),
}

Predict = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class CustomModel:
    """A caller's model: ``build_model(params)`` returns a ``pyspark.ml`` estimator."""

    name: str
    task: str
    build_model: Callable[[dict[str, Any]], Any]
    defaults: Mapping[str, Any] | None = None


@dataclass(frozen=True)
class Fitted:
    """``predict`` adds the column ``prediction``; ``inertia`` is set by k-means."""

    predict: Predict
    inertia: float | None = None


def starter_pair(task: str) -> tuple[str, str]:
    return STARTER_PAIRS.get(task, STARTER_PAIRS["clustering"])


def parameters(model_id: str, given: Mapping[str, Any] | None = None) -> dict[str, Any]:
    """The defaults with the caller's changes; an unknown parameter is an error."""
    defaults = MODELS[model_id].defaults
    unknown = sorted(set(given or {}) - set(defaults))
    if unknown:
        raise TableError(f"{MODELS[model_id].name} has no parameter {', '.join(unknown)}.")
    return {**defaults, **(given or {})}


def fit_model(model_id: str, params: Mapping[str, Any], train: DataFrame, rows: int, seed: int) -> Fitted:
    """Train a built-in model on ``features`` and ``label`` (clustering: ``features`` alone)."""
    return _FITTERS[model_id](dict(params), _for_training(train), rows, seed)


def _for_training(train: DataFrame) -> DataFrame:
    """The columns that training reads, over at least as many partitions as there are cores.

    A new table even if the given one is cached: the estimators of ``pyspark.ml`` then keep their own decoded form
    of the rows between iterations, instead of decoding the cached columns in each of them.
    """
    return _over_cores(train.select(*[name for name in (FEATURES, LABEL) if name in train.columns]))


def _over_cores(df: DataFrame) -> DataFrame:
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def fit_custom(model: CustomModel, params: Mapping[str, Any] | None, train: DataFrame) -> tuple[Fitted, dict[str, Any]]:
    """Build, check and train a caller's model on the same features."""
    merged = {**(model.defaults or {}), **(params or {})}
    estimator = model.build_model(dict(merged))
    if not callable(getattr(estimator, "fit", None)):
        raise TableError(f"build_model must return an estimator with a fit method, not {type(estimator).__name__}.")
    for setter, column in (("featuresCol", FEATURES), ("labelCol", LABEL), ("predictionCol", PREDICTION)):
        if getattr(estimator, "hasParam", lambda _: False)(setter):
            estimator.set(estimator.getParam(setter), column)
    fitted = estimator.fit(train)
    if not callable(getattr(fitted, "transform", None)):
        raise TableError("The trained model must have a transform method.")

    def predict(df: DataFrame) -> DataFrame:
        result = fitted.transform(df)
        if PREDICTION not in result.columns:
            raise TableError(f"The trained model must add a column '{PREDICTION}'.")
        return result

    cost = getattr(getattr(fitted, "summary", None), "trainingCost", None) if model.task == "clustering" else None
    return Fitted(predict, cost), merged


def _depth(params: dict[str, Any]) -> int:
    depth = params["max_depth"]
    if depth is None:
        raise TableError(f"A tree without a limit is not available; max_depth must lie between 1 and {MAX_DEPTH}.")
    if not 1 <= int(depth) <= MAX_DEPTH:
        raise TableError(f"max_depth must lie between 1 and {MAX_DEPTH}.")
    return int(depth)


def _refuse(params: dict[str, Any], name: str, allowed: tuple) -> None:
    if params[name] not in allowed:
        shown = ", ".join(str(value) for value in allowed)
        raise TableError(f"{name}={params[name]!r} is not available here; use one of: {shown}.")


def _feature_share(value: Any) -> str:
    """``max_features`` in Spark's terms."""
    if value in (None, "auto"):
        return "all"
    return str(value)


def _fit_tree(params, train: DataFrame, rows: int, seed: int) -> Fitted:
    _refuse(params, "criterion", ("auto", "gini", "entropy", "log_loss"))
    _refuse(params, "splitter", ("best",))
    _refuse(params, "min_samples_split", (2,))
    common = {
        "featuresCol": FEATURES, "labelCol": LABEL, "predictionCol": PREDICTION, "seed": seed, "maxBins": MAX_BINS,
        "maxMemoryInMB": NODE_MEMORY,
        "maxDepth": _depth(params), "minInstancesPerNode": int(params["min_samples_leaf"]),
        "impurity": "gini" if params["criterion"] in ("auto", "gini") else "entropy",
    }
    share = _feature_share(params["max_features"])
    if share == "all":
        return Fitted(DecisionTreeClassifier(**common).fit(train).transform)
    # A forest of one tree on all rows is a tree that looks at part of the features in each split.
    forest = RandomForestClassifier(numTrees=1, bootstrap=False, featureSubsetStrategy=share, **common)
    return Fitted(forest.fit(train).transform)


def _fit_logistic(params, train: DataFrame, rows: int, seed: int) -> Fitted:
    """The penalty is spread over the rows, as Spark minimises a mean and C weighs a sum."""
    _refuse(params, "class_weight", ("none", None, "balanced"))
    _refuse(params, "solver", ("lbfgs",))
    model = LogisticRegression(
        featuresCol=FEATURES, labelCol=LABEL, predictionCol=PREDICTION, elasticNetParam=0.0, standardization=False,
        regParam=1.0 / (float(params["C"]) * rows), maxIter=int(params["max_iter"]), tol=float(params["tol"]),
    )
    if params["class_weight"] == "balanced":
        sizes = {row[LABEL]: row["count"] for row in train.groupBy(LABEL).count().collect()}
        weights = [sizes.get(float(c)) for c in range(int(max(sizes)) + 1)]
        shares = [rows / (len(sizes) * n) if n else 0.0 for n in weights]
        table = F.array(*[F.lit(share) for share in shares])
        train = train.withColumn(WEIGHT, F.element_at(table, F.col(LABEL).cast("int") + 1))
        model.setWeightCol(WEIGHT)
    return Fitted(model.fit(train).transform)


def _fit_linear(params, train: DataFrame, rows: int, seed: int) -> Fitted:
    if params["positive"]:
        return _fit_nonnegative(train, bool(params["fit_intercept"]))
    model = LinearRegression(
        featuresCol=FEATURES, labelCol=LABEL, predictionCol=PREDICTION, regParam=0.0,
        fitIntercept=bool(params["fit_intercept"]),
    )
    return Fitted(model.fit(train).transform)


def _fit_nonnegative(train: DataFrame, intercept: bool) -> Fitted:
    """Least squares with coefficients of at least 0.

    Rows are centred first. Each task sums the outer products of its rows, and these sums are added up a few at a time; the one
    matrix of features by features reaches the driver, which solves for it. It must fit there, so wider tables are refused.
    """
    width = train.select(F.size(vector_to_array(FEATURES))).first()[0]
    if (width + 1) ** 2 * 8 > GRAM_BYTES:
        raise TableError(f"positive=True works on at most {int((GRAM_BYTES / 8) ** 0.5) - 1} features; here are {width}.")
    means = train.agg(Summarizer.mean(F.col(FEATURES)).alias("x"), F.avg(LABEL).alias("y")).first()
    centre, level = means["x"].toArray(), float(means["y"])
    away, above = (centre, level) if intercept else (np.zeros(width), 0.0)
    rows = train.select(vector_to_array(FEATURES).alias("x"), F.col(LABEL).cast("double").alias("y"))

    def outer_products(batches):
        total = np.zeros((width + 1, width + 1))
        for batch in batches:
            if len(batch):
                block = np.column_stack([np.stack(batch["x"].to_numpy()) - away, batch["y"].to_numpy() - above])
                total += block.T @ block
        yield pd.DataFrame({"part": [TaskContext.get().partitionId()], "sums": [total.tobytes()]})

    def added(group):
        total = sum(np.frombuffer(sums) for sums in group.sort_values("part")["sums"])
        return pd.DataFrame({"part": [int(group["part"].min()) // TOGETHER], "sums": [total.tobytes()]})

    kind = "part bigint, sums binary"
    parts = rows.mapInPandas(outer_products, kind)
    tasks = rows.rdd.getNumPartitions()
    while tasks > TOGETHER:
        parts = parts.groupBy(F.floor(F.col("part") / TOGETHER)).applyInPandas(added, kind)
        tasks = -(-tasks // TOGETHER)
    moments = sum(np.frombuffer(row["sums"]) for row in parts.orderBy("part").collect()).reshape(width + 1, width + 1)
    gram, target = moments[:width, :width], moments[:width, width]
    weights = _nonnegative_solution(gram, target)
    offset = float(level - centre @ weights) if intercept else 0.0
    table = F.array(*[F.lit(float(v)) for v in weights])

    def predict(df: DataFrame) -> DataFrame:
        terms = F.zip_with(vector_to_array(FEATURES), table, lambda x, b: x * b)
        return df.withColumn(PREDICTION, F.aggregate(terms, F.lit(offset), lambda total, term: total + term))

    return Fitted(predict)


def _nonnegative_solution(gram: np.ndarray, target: np.ndarray, rounds: int = 10_000) -> np.ndarray:
    """Minimise the quadratic over non-negative weights, one coordinate at a time."""
    weights = np.zeros(len(target))
    pull = -target.astype(float)
    for _ in range(rounds):
        largest = 0.0
        for j in range(len(weights)):
            if gram[j, j] <= 1e-12:
                continue
            moved = max(0.0, weights[j] - pull[j] / gram[j, j])
            step = moved - weights[j]
            if step:
                pull += step * gram[:, j]
                weights[j] = moved
                largest = max(largest, abs(step) * np.sqrt(gram[j, j]))
        if largest <= 1e-12 * (1.0 + np.sqrt(abs(target).max(initial=0.0))):
            break
    return weights


def _fit_forest(params, train: DataFrame, rows: int, seed: int) -> Fitted:
    _refuse(params, "criterion", ("auto", "squared_error"))
    _refuse(params, "min_samples_split", (2,))
    model = RandomForestRegressor(
        featuresCol=FEATURES, labelCol=LABEL, predictionCol=PREDICTION, seed=seed, maxBins=MAX_BINS,
        maxMemoryInMB=NODE_MEMORY, cacheNodeIds=True,  # rows stay at their nodes instead of going down each tree again
        numTrees=int(params["n_estimators"]), maxDepth=_depth(params),
        minInstancesPerNode=int(params["min_samples_leaf"]), bootstrap=bool(params["bootstrap"]),
        featureSubsetStrategy=_feature_share(params["max_features"]),
    ).fit(train)
    return Fitted(lambda df: model.transform(_over_cores(df)))  # a row goes down every tree: more work than to hand it on


def _check_clusters(params, rows: int) -> int:
    clusters = int(params["n_clusters"])
    if not 2 <= clusters < rows:
        raise TableError(f"The number of clusters must lie between 2 and {rows - 1} for this table.")
    return clusters


def _not_cached_itself(kept: DataFrame) -> DataFrame:
    """The same rows, with a column more, as a table that is not the cached one: k-means then keeps their decoded form.

    It has a dozen passes, and would decode a cached table in each. A mere choice of its columns still counts as cached.
    """
    return kept.withColumn(WEIGHT, F.lit(1.0))


def _fit_kmeans(params, train: DataFrame, rows: int, seed: int) -> Fitted:
    """The best of ``n_init`` starts by training cost."""
    _refuse(params, "init", ("k-means++", "random"))
    starts = 1 if params["n_init"] == "auto" else int(params["n_init"])
    clusters = _check_clusters(params, rows)
    kept = train.select(FEATURES).persist(StorageLevel.MEMORY_AND_DISK)  # all starts read the one cached form
    best = None
    try:
        for start in range(max(1, starts)):
            model = KMeans(
                featuresCol=FEATURES, predictionCol=PREDICTION, k=clusters, seed=seed + start,
                maxIter=int(params["max_iter"]), tol=float(params["tol"]),
                initMode="random" if params["init"] == "random" else "k-means||",
            ).fit(_not_cached_itself(kept))
            if best is None or model.summary.trainingCost < best.summary.trainingCost:
                best = model
    finally:
        kept.unpersist()
    return Fitted(best.transform, float(best.summary.trainingCost))


def _fit_agglomerative(params, train: DataFrame, rows: int, seed: int) -> Fitted:
    clusters = Agglomerative(_check_clusters(params, rows), params["linkage"], seed, int(params["groups"]), params["method"])
    return Fitted(clusters.fit(train, PREDICTION))


_FITTERS = {
    "decision_tree": _fit_tree,
    "logistic_regression": _fit_logistic,
    "linear_regression": _fit_linear,
    "random_forest": _fit_forest,
    "kmeans": _fit_kmeans,
    "agglomerative_clustering": _fit_agglomerative,
}
