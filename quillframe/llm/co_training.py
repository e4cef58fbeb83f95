"""Quality scores by co-training of two views.

The content view sees how the characters and words of a text follow one another; the metadata view sees where the page
comes from, its language, its size and its layout. Each is a logistic regression, trained on the labelled documents. In every
round each view labels the documents without label that it is sure of, over the whole table, and these are added to what
the other view is trained on. At last each view is calibrated on labelled documents that no round has seen, and the
calibrated log-odds are added up, as the views are taken to be independent given the quality.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F, types as T

from quillframe.functions.sizing import store
from quillframe.llm.common import arrow_schema, column, slices

CLASSES = 16
LAYOUT = 8
BUCKETS = 64  # of the source and language of a page


def _byte_classes() -> np.ndarray:
    """Bytes by what they are in a text: lower and upper letters, digits, white space, marks, and parts of other characters."""
    table = np.full(256, 15, np.int64)
    table[128:] = 0
    for number, members in enumerate(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\n\r\t\x0b\x0c", ".", ",", ";:", "!?", "'\"", "()[]{}<>", "|", "*#", "%$&@", "-_=+/\\~^`")):
        table[[ord(c) for c in members]] = number
    return table


BYTE_CLASS = _byte_classes()


def content(text: str) -> np.ndarray:
    """Shares of pairs of neighbouring byte classes, and how often words come again."""
    data = BYTE_CLASS[np.frombuffer(text.encode("utf-8", "replace"), np.uint8)]
    pairs = np.bincount(data[:-1] * CLASSES + data[1:], minlength=CLASSES * CLASSES) if len(data) > 1 else np.zeros(CLASSES * CLASSES)
    words = text.split()
    again = sum(a == b for a, b in zip(words, words[1:])) / max(1, len(words) - 1)
    return np.r_[np.sqrt(pairs / max(1, len(data) - 1)), again, len(set(words)) / max(1, len(words))].astype(np.float32)


def layout(text: str) -> np.ndarray:
    """Size and layout: characters, lines, their lengths, words, bytes per character."""
    lines = text.split("\n")
    sizes = np.array([len(line) for line in lines], dtype=np.float64)
    n_words = text.count(" ") + len(lines)
    return np.array([
        np.log1p(len(text)), np.log1p(len(lines)), np.log1p(sizes.mean()), np.log1p(sizes.max()), sizes.std() / (1 + sizes.mean()), np.mean(sizes == 0),
        np.log1p(len(text) / n_words), len(text.encode("utf-8", "replace")) / max(1, len(text)),
    ], dtype=np.float32)


def features(docs: DataFrame) -> DataFrame:
    """``doc_id, content, meta`` of each row, the views as arrays of numbers."""
    bucket = lambda name: F.pmod(F.xxhash64(F.coalesce(column(docs, name, "string"), F.lit("")), F.lit(name)), F.lit(BUCKETS // 2)).cast("int")
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("content", T.ArrayType(T.FloatType())), T.StructField("meta", T.ArrayType(T.FloatType()))])

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = arrow_schema(schema)
        for batch in slices(batches):
            texts = [text or "" for text in batch["text"].to_pylist()]
            one_hot = np.zeros((len(texts), BUCKETS), np.float32)
            for shift, name in ((0, "source"), (BUCKETS // 2, "lang")):
                one_hot[np.arange(len(texts)), batch[name].to_numpy() + shift] = 1
            views = np.stack([content(t) for t in texts]), np.hstack([np.stack([layout(t) for t in texts]), one_hot])
            arrays = [pa.ListArray.from_arrays(np.arange(0, view.size + 1, view.shape[1], dtype=np.int32), view.ravel()) for view in views]
            yield pa.RecordBatch.from_arrays([batch["doc_id"].cast(target.field(0).type), *arrays], schema=target)

    source = docs.select(column(docs, "doc_id").alias("doc_id"), column(docs, "text", "string").alias("text"), bucket("source").alias("source"), bucket("lang").alias("lang"))
    return source.mapInArrow(look, schema)


def _fit(rows: DataFrame, view: str) -> LogisticRegressionModel:
    """A classifier of one view. Both classes weigh the same, as confident labels can be of one class mostly."""
    counts = {row.label: row.n for row in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    weighted = rows.select(array_to_vector(view).alias("features"), "label", F.when(F.col("label") == 1, 0.5 / counts[1.0]).otherwise(0.5 / counts[0.0]).alias("weight"))
    return LogisticRegression(regParam=1e-4, maxIter=30, weightCol="weight").fit(weighted)


def _odds(model: LogisticRegressionModel, view: str) -> Column:
    """The log-odds of a row, as an expression: no pass of its own."""
    weights = F.array(*[F.lit(float(w)) for w in model.coefficients])
    products = F.zip_with(F.col(view).cast("array<double>"), weights, lambda x, w: x * w)
    return F.aggregate(products, F.lit(float(model.intercept)), lambda total, x: total + x)


def platt(odds: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset that turn log-odds into calibrated ones, by Newton's steps on softened labels."""
    ones = labels.sum()
    target = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (len(labels) - ones + 2))
    x, w = np.stack([odds, np.ones_like(odds)], axis=1), np.array([0.0, np.log((ones + 1) / (len(labels) - ones + 1))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - target) + 1e-3 * w
        bend = (x * (p * (1 - p))[:, None]).T @ x + np.diag([1e-3, 1e-3])
        step = np.linalg.solve(bend, slope)
        w = w - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def quality_scores(docs: DataFrame, labels: DataFrame, *, rounds: int = 2, sure: float = 0.95, calibration_rows: int = 20_000, label: str = "quality") -> DataFrame:
    """``doc_id, score, keep, content_score, meta_score`` of each row of ``docs``.

    ``score`` is the calibrated probability of quality 1 by both views, ``keep`` whether it is at least a half, and the
    others are the calibrated probabilities by one view. Labels other than 0 and 1 and those without ``doc_id`` are left out; a
    document whose labels differ has that of the majority, and none if they are even. ``calibration_rows`` bounds, on average,
    the labelled rows that the calibration is fitted on; they are a fifth of all or fewer. If one class has no label, all
    scores are the share of labels that are 1, or 0.5 if there are no labels. NULL texts are empty. Repeated rows are
    scored like any other. An empty table gives no rows.
    """
    views = ("content", "meta")
    votes = labels.where(column(labels, label).isin(0, 1) & column(labels, "doc_id").isNotNull()).groupBy(column(labels, "doc_id").alias("of")).agg(F.avg(column(labels, label).cast("double")).alias("vote"))
    decided = store(votes.where("vote <> 0.5").select("of", F.round("vote").alias("label"), (F.pmod(F.xxhash64("of", F.lit("calibration")), F.lit(5)) == 0).alias("aside")))
    # the one join of the features: each row has its label beside it from here on
    seen = store(features(docs).join(decided, F.col("doc_id") == F.col("of"), "left").select("doc_id", *views, "label", "aside"))
    known = seen.where("label IS NOT NULL")
    classes = {(row.aside, row.label): row.n for row in known.groupBy("aside", "label").agg(F.count("*").alias("n")).collect()}
    if any((False, one) not in classes for one in (0.0, 1.0)):
        total, ones = sum(classes.values()), sum(n for (_, one), n in classes.items() if one == 1)
        share = F.lit(ones / total if total else 0.5)
        return seen.select("doc_id", share.alias("score"), (share >= 0.5).alias("keep"), share.alias("content_score"), share.alias("meta_score"))
    trained = known.where("NOT aside")
    open_ = seen.where("label IS NULL")
    models = {view: _fit(trained, view) for view in views}
    bound = float(np.log(sure / (1 - sure)))
    for _ in range(rounds):
        judged = {view: open_.withColumn("odds", _odds(models[view], view)).where(F.abs("odds") >= bound).withColumn("label", (F.col("odds") > 0).cast("double")) for view in views}
        models = {mine: _fit(trained.select(mine, "label").union(judged[other].select(mine, "label")), mine) for mine, other in (views, views[::-1])}
    rate = min(1.0, calibration_rows / max(1, sum(n for (aside, _), n in classes.items() if aside)))
    kept = known.where("aside").where(F.pmod(F.xxhash64("doc_id", F.lit("bound")), F.lit(1 << 30)) < int(rate * (1 << 30)))
    rows = kept.select("label", *[_odds(models[view], view).alias(view) for view in views]).collect()  # bounded by calibration_rows
    truth = np.array([row.label for row in rows])
    prior = float(np.log((truth.sum() + 1) / (len(truth) - truth.sum() + 1)))
    calibrated = {}
    for view in views:
        slope, offset = platt(np.array([row[view] for row in rows]), truth) if len(rows) else (1.0, 0.0)
        calibrated[view] = _odds(models[view], view) * slope + offset
    chance = lambda odds: 1 / (1 + F.exp(-odds))
    odds = seen.select("doc_id", *[calibrated[view].alias(view) for view in views])
    scored = odds.select("doc_id", chance(F.col("content") + F.col("meta") - prior).alias("score"), chance(F.col("content")).alias("content_score"), chance(F.col("meta")).alias("meta_score"))
    return scored.select("doc_id", "score", (F.col("score") >= 0.5).alias("keep"), "content_score", "meta_score")
