"""Training one or two models on the same rows, features and split, and setting their metrics side by side."""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone
from typing import Any

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from quillframe.errors import TableError
from quillframe.functions.missing import fold_nan
from quillframe.functions.hashing import row_digest
from quillframe.functions.sizing import settle, store
from quillframe.functions.types import as_number, quoted, refuse_nested
from quillframe.operators import metrics as M
from quillframe.operators.comparison import pivot_metrics
from quillframe.operators.features import FEATURES, FeaturePlan, decode_label, encode_label, fit_features, label_order
from quillframe.operators.models import (
    LABEL, MODELS, PREDICTION, CustomModel, Fitted, fit_custom, fit_model, parameters,
)
from quillframe.operators.projection import rows_with_any_feature, rows_with_target
from quillframe.operators.sampling import (
    BUDGET_ALIASES, SPLIT, ClassSizes, can_stratify, class_sizes, random_split, require_rows, split_parts, stratified_split,
    within_budget,
)
from quillframe.plans.profile import detect_task

TRAIN_PCT = 70  # fixed value: default training share
SEED = 42  # fixed value: default seed
MAX_MODELS = 2  # fixed value: most models of one comparison
ROW_KEY = "_row_key"
_ID = "_order_key"


@dataclass(frozen=True)
class ModelRequest:
    """A built-in model by its id, or a caller's own, with changed parameters."""

    model: str | CustomModel
    params: Mapping[str, Any] | None = None

    @property
    def id(self) -> str:
        return self.model if isinstance(self.model, str) else f"custom:{self.model.name}"

    @property
    def name(self) -> str:
        return MODELS[self.model].name if isinstance(self.model, str) else self.model.name


@dataclass(frozen=True)
class ModelResult:
    id: str
    name: str
    task: str
    params: dict[str, Any]
    metrics: dict[str, float]
    chart: DataFrame
    training_seconds: float
    rows_used: int
    train_rows: int | None = None
    test_rows: int | None = None

    # ``chart`` has the confusion counts that occur, some actual and predicted values, or the cluster sizes.


@dataclass(frozen=True)
class Comparison:
    id: str
    target: str
    task: str
    columns: list[str]
    train_pct: int
    seed: int
    mode: str
    rows_available: int
    rows_processed: int
    models: list[ModelResult]
    elapsed_seconds: float
    created_at: str
    dataset_id: str | None = None
    dataset_name: str | None = None
    spark: SparkSession | None = field(default=None, repr=False)

    def metrics(self) -> DataFrame:
        """``model, metric, value``."""
        rows = [(name, metric, value) for m, name in zip(self.models, self.names()) for metric, value in m.metrics.items()]
        return self.spark.createDataFrame(rows, "model string, metric string, value double")

    def side_by_side(self) -> DataFrame:
        """One row per metric, one column per model."""
        return pivot_metrics(self.metrics(), self.names())

    def names(self) -> list[str]:
        """The names of the models, numbered from the second on if several share one."""
        return distinct_names([m.name for m in self.models])


def distinct_names(names: Sequence[str]) -> list[str]:
    found: list[str] = []
    for name in names:
        number, unused = 1, name
        while unused in found:
            number += 1
            unused = f"{name} ({number})"
        found.append(unused)
    return found


def compatible(model_id: str, task: str) -> bool:
    """Clustering fits every table; any other model must solve the task of the target."""
    if model_id not in MODELS:
        return False
    own = MODELS[model_id].task
    return own == "clustering" or own == task


def check_requests(requests: Sequence[ModelRequest], task: str) -> str:
    """The one task of all requested models; models of different tasks cannot be compared."""
    if not 1 <= len(requests) <= MAX_MODELS:
        raise TableError(f"Compare between one and {MAX_MODELS} models.")
    tasks = []
    for request in requests:
        if isinstance(request.model, CustomModel):
            own = request.model.task
            if own != "clustering" and own != task:
                raise TableError(f"The model '{request.model.name}' is made for {own}, the target needs {task}.")
        elif not compatible(request.model, task):
            raise TableError(f"The model '{request.model}' does not fit a target of the kind {task}.")
        else:
            own = MODELS[request.model].task
        tasks.append(own)
    if len(set(tasks)) > 1:
        raise TableError("The models solve different tasks, so their metrics cannot be compared.")
    return tasks[0]


def compare_models(
    df: DataFrame,
    target: str,
    requests: Sequence[ModelRequest | str],
    train_pct: int = TRAIN_PCT,
    seed: int = SEED,
    mode: str = "full",
    columns: Sequence[str] | None = None,
    key: Sequence[str] = (),
    task: str | None = None,
    dataset_id: str | None = None,
    dataset_name: str | None = None,
) -> Comparison:
    """Train and score the requested models.

    ``key`` names columns that identify a row; splits and samples are drawn from it. Without one, the digest of the columns in
    use is the key: the same rows are split alike however they are stored, and copies fall on one side. The task is that of
    the whole table unless given. The split rows are written once and the prepared rows are cached while the models train, since
    training reads them many times; everything they depend on is repeatable, so a lost executor only costs time.
    """
    started = time.perf_counter()
    wanted = [request if isinstance(request, ModelRequest) else ModelRequest(request) for request in requests]
    if not 1 <= train_pct <= 99:
        raise TableError("The training share must lie between 1 and 99 percent.")
    if target not in df.columns:
        raise TableError(f"There is no target column '{target}'.")
    refuse_nested(df)
    df = fold_nan(df)
    chosen = [c for c in dict.fromkeys(columns or df.columns) if c in df.columns]
    chosen += [] if target in chosen else [target]
    features = [c for c in chosen if c != target and (columns or c not in key)]
    available = df.count()
    task = task or detect_task(df, target).first()["task"]
    shared = check_requests(wanted, task)
    if not features:
        raise TableError("No feature column is left beside the target.")
    rows = df.select(*[quoted(c) for c in dict.fromkeys([*key, *features, target])])
    if not key:
        rows, key = rows.withColumn(ROW_KEY, F.hex(row_digest(rows))), [ROW_KEY]
    sampled = within_budget(rows, mode, key, seed)
    processed = available
    if sampled is not rows:
        sampled = settle(sampled)
        processed = sampled.count()
    run = _run_clustering if shared == "clustering" else _run_supervised
    models = run(sampled, target, features, shared, wanted, train_pct, seed, list(key))
    return Comparison(
        id=uuid.uuid4().hex,
        target=target,
        task=shared,
        columns=chosen,
        train_pct=train_pct,
        seed=seed,
        mode=BUDGET_ALIASES.get(mode, mode),
        rows_available=available,
        rows_processed=processed,
        models=models,
        elapsed_seconds=round(time.perf_counter() - started, 4),
        created_at=datetime.now(timezone.utc).isoformat(timespec="microseconds"),
        dataset_id=dataset_id,
        dataset_name=dataset_name,
        spark=df.sparkSession,
    )


def _fit(request: ModelRequest, train: DataFrame, rows: int, seed: int) -> tuple[Fitted, dict[str, Any], float]:
    started = time.perf_counter()
    if isinstance(request.model, CustomModel):
        fitted, params = fit_custom(request.model, request.params, train)
    else:
        params = parameters(request.model, request.params)
        fitted = fit_model(request.model, params, train, rows, seed)
    return fitted, params, round(time.perf_counter() - started, 4)


def _figures(*tables: DataFrame) -> dict[str, float]:
    """The rounded figures of one-row tables, without NULLs."""
    found = {}
    for table in tables:
        found.update({row["metric"]: row["value"] for row in M.long_form(table).collect() if row["value"] is not None})
    return found


def _run_supervised(
    df: DataFrame, target: str, features: list[str], task: str, requests: Sequence[ModelRequest],
    train_pct: int, seed: int, key: list[str],
) -> list[ModelResult]:
    used = require_rows(rows_with_target(df, target))
    sizes = class_sizes(used, target) if task == "classification" else None
    if sizes is not None and can_stratify(sizes):
        split = stratified_split(used, target, train_pct, key, seed, sizes)
    else:
        split = random_split(used, train_pct, key, seed, exact=True)
    slim = dict.fromkeys([*key, *features, target])
    train, test = split_parts(store(split.select(*[quoted(c) for c in slim], SPLIT)))
    plan = fit_features(train, features)
    train_ready = _prepared(plan, train, target, task, key, training=True)
    test_ready = _prepared(plan, test, target, task, key, training=False)
    # Every class that can be stratified has training rows, and their names are counted already.
    order = [] if sizes is None else _classes(sizes) if can_stratify(sizes) else label_order(train_ready, "actual")
    if task == "classification":
        train_ready = encode_label(train_ready, "actual", order, LABEL)
    train_ready.persist(StorageLevel.MEMORY_AND_DISK)
    test_ready.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        train_rows, test_rows = train_ready.count(), test_ready.count()
        if not train_rows or not test_rows:
            raise TableError("The split leaves no rows on one side; choose another training share.")
        results = []
        for request in requests:
            fitted, params, seconds = _fit(request, train_ready, train_rows, seed)
            sides = [_with_answers(fitted.predict(part), task, order).withColumn(SPLIT, F.lit(side)) for side, part in (("test", test_ready), ("train", train_ready))]
            metrics, chart = _supervised_figures(sides[0], sides[1], task, isinstance(request.model, str))
            results.append(
                ModelResult(
                    request.id, request.name, task, params, metrics, chart, seconds,
                    train_rows + test_rows, train_rows, test_rows,
                )
            )
    finally:
        train_ready.unpersist()
        test_ready.unpersist()
    return results


def _prepared(plan: FeaturePlan, part: DataFrame, target: str, task: str, key: list[str], training: bool) -> DataFrame:
    """``features, actual`` and the order key; regression rows also carry the label."""
    actual = quoted(target).cast("string") if task == "classification" else as_number(part, target)
    order = F.struct(*[quoted(k) for k in key])
    kept = part.select("*", actual.alias("_actual"), order.alias(_ID))
    ready = plan.apply(kept, training).select(FEATURES, F.col("_actual").alias("actual"), _ID)
    return ready if task == "classification" else ready.withColumn(LABEL, F.col("actual"))


def _classes(sizes: ClassSizes) -> list[str]:
    return sorted(row[0] for row in sizes.table.select(F.col("_class").cast("string")).distinct().collect())


def _with_answers(predicted: DataFrame, task: str, order: list[str]) -> DataFrame:
    named = decode_label(predicted, PREDICTION, order, "_answer") if task == "classification" else predicted.withColumn("_answer", F.col(PREDICTION))
    return named.select("actual", F.col("_answer").alias("predicted"), _ID)


def _supervised_figures(
    scored: DataFrame, fit_side: DataFrame, task: str, built_in: bool
) -> tuple[dict[str, float], DataFrame]:
    """Test metrics, the same figure on the training rows for built-in models, and the chart."""
    if task == "classification":
        # One aggregation over the rows of both sides; the figures come from its counts.
        rows = scored.union(fit_side) if built_in else scored
        pair = [F.col(name).cast("string").alias(name) for name in ("actual", "predicted")]
        counted = settle(rows.groupBy(SPLIT, *pair).agg(F.count(F.lit(1)).alias("n")))
        counts = counted.where(F.col(SPLIT) == "test").drop(SPLIT)
        tables = [M.scores_of(counts)]
        if built_in:
            hits = F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0))
            fit_counts = counted.where(F.col(SPLIT) == "train")
            tables.append(fit_counts.agg(F.try_divide(hits.cast("double"), F.sum("n")).alias("training_accuracy")))
        chart = counts
    else:
        tables = [M.regression_metrics(scored, "actual", "predicted")]
        if built_in:
            tables.append(M.r2(fit_side, "actual", "predicted").withColumnRenamed("r2", "training_r2"))
        chart = settle(M.actual_predicted_sample(scored, "actual", "predicted", [_ID]).select("actual", "predicted"))
    return _figures(*tables), chart


def _run_clustering(
    df: DataFrame, target: str, features: list[str], task: str, requests: Sequence[ModelRequest],
    train_pct: int, seed: int, key: list[str],
) -> list[ModelResult]:
    results = []
    plans: dict[bool, tuple[DataFrame, int]] = {}
    try:
        for request in requests:
            custom = isinstance(request.model, CustomModel)
            if custom not in plans:
                used = require_rows(rows_with_any_feature(df, features) if custom else df)
                ready = fit_features(used, features).apply(used, training=True)
                ready = ready.persist(StorageLevel.MEMORY_AND_DISK)
                plans[custom] = ready, ready.count()
            ready, rows = plans[custom]
            fitted, params, seconds = _fit(request, ready, rows, seed)
            labelled = fitted.predict(ready).persist(StorageLevel.MEMORY_AND_DISK)
            try:
                metrics = _clustering_figures(labelled, target, fitted, custom)
                chart = settle(M.cluster_sizes(labelled, PREDICTION))
            finally:
                labelled.unpersist()
            results.append(ModelResult(request.id, request.name, task, params, metrics, chart, seconds, rows))
    finally:
        for ready, _ in plans.values():
            ready.unpersist()
    return results


def _clustering_figures(
    labelled: DataFrame, target: str, fitted: Fitted, custom: bool
) -> dict[str, float]:
    """Scores are taken on all rows. The Euclidean silhouette and the Davies-Bouldin score are left out where there are too many clusters for them."""
    figures: dict[str, float] = {}
    sizes = M.cluster_count(labelled, PREDICTION).first()
    if custom:
        figures["clusters"] = float(sizes["clusters"])
    if sizes["scorable"]:
        scores = [M.squared_silhouette] if custom else [M.squared_silhouette, M.calinski_harabasz]
        if not custom and sizes["clusters"] <= M.MAX_CLUSTERS:
            scores.append(M.davies_bouldin)
        tables = [score(labelled, FEATURES, PREDICTION) for score in scores]
        if sizes["clusters"] <= M.MAX_CLUSTERS:
            tables.append(M.silhouette(labelled, FEATURES, PREDICTION))
        figures.update(_figures(*tables))
    if not custom:
        kinds = labelled.agg(F.min(quoted(target)), F.max(quoted(target))).first()
        if kinds[0] is not None and kinds[0] != kinds[1]:
            figures.update(_figures(M.adjusted_rand_index(labelled, target, PREDICTION)))
    if fitted.inertia is not None:
        figures["inertia"] = round(float(fitted.inertia), M.DIGITS)
    return figures
