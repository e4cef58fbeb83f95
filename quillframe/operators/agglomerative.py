"""Bottom-up clustering of any number of rows.

``method="grouped"`` works in two levels at every size: Spark reduces the rows to ``groups`` weighted k-means groups, which
are merged pair by pair on the driver, and every row gets the cluster of its group. ``method="exact"`` merges the distinct rows
themselves: for ``single`` linkage any number of them, by a spanning tree (:mod:`quillframe.operators.single_linkage`); the other
linkages refuse tables with more than ``EXACT_ROWS`` of them. The caller chooses; the size of the table does not.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from quillframe.errors import TableError
from quillframe.functions.sizing import broadcast_if_small
from quillframe.operators.features import FEATURES
from quillframe.operators.single_linkage import single_linkage

GROUPS = 512
GROUP_ROUNDS = 100
EXACT_ROWS = 4096  # distinct rows whose pairs fit on the driver
METHODS = ("grouped", "exact")
LINKAGES = ("ward", "complete", "average", "single")


@dataclass(frozen=True)
class Agglomerative:
    clusters: int = 3
    linkage: str = "ward"
    seed: int = 42
    groups: int = GROUPS
    method: str = "grouped"

    def fit(self, df: DataFrame, output: str = "prediction") -> Callable[[DataFrame], DataFrame]:
        """Group and merge the rows; the result adds the cluster number to any table of such rows."""
        if self.linkage not in LINKAGES:
            raise TableError(f"Unknown linkage '{self.linkage}'; choose one of {', '.join(LINKAGES)}.")
        if self.method not in METHODS:
            raise TableError(f"Unknown method '{self.method}'; choose one of {', '.join(METHODS)}.")
        if self.method == "grouped":
            return self._fit_groups(df, output)
        if self.linkage == "single":
            return self._fit_tree(df, output)
        copies = df.groupBy(vector_to_array(FEATURES).alias("_point")).agg(F.count(F.lit(1)).alias("n")).limit(EXACT_ROWS + 1).collect()
        if len(copies) > EXACT_ROWS:
            raise TableError(f"Exact merging takes at most {EXACT_ROWS} different rows unless the linkage is single; use method='grouped'.")
        return self._fit_points(df.sparkSession, copies, output)

    def _fit_tree(self, df: DataFrame, output: str) -> Callable[[DataFrame], DataFrame]:
        found = single_linkage(df.select(vector_to_array(FEATURES).alias("x")), self.clusters)
        labels = broadcast_if_small(found.select(F.col("x").alias("_point"), F.col("cluster").alias(output)))

        def label(df: DataFrame) -> DataFrame:
            return df.join(labels, vector_to_array(FEATURES) == F.col("_point"), "left").drop("_point")

        return label

    def _fit_points(self, spark: SparkSession, copies: list[Row], output: str) -> Callable[[DataFrame], DataFrame]:
        copies = sorted(copies, key=lambda row: row["_point"])
        final = merge([row["_point"] for row in copies], [row["n"] for row in copies], self.clusters, self.linkage)
        labels = spark.createDataFrame(
            [(row["_point"], int(c)) for row, c in zip(copies, final)], f"_point array<double>, {output} int"
        )

        def label(df: DataFrame) -> DataFrame:
            # At most EXACT_ROWS rows, so the table of labels is small.
            return df.join(F.broadcast(labels), vector_to_array(FEATURES) == F.col("_point"), "left").drop("_point")

        return label

    def _fit_groups(self, df: DataFrame, output: str) -> Callable[[DataFrame], DataFrame]:
        model = KMeans(k=self.groups, seed=self.seed, maxIter=GROUP_ROUNDS, featuresCol=FEATURES, predictionCol="_group").fit(df)
        centres = model.clusterCenters()
        sizes = {row["_group"]: row["count"] for row in model.transform(df).groupBy("_group").count().collect()}
        used = sorted(sizes)
        final = merge([centres[g] for g in used], [sizes[g] for g in used], self.clusters, self.linkage)
        lookup = dict(zip(used, final))
        table = F.array(*[F.lit(int(lookup.get(g, 0))) for g in range(len(centres))])

        def label(df: DataFrame) -> DataFrame:
            return model.transform(df).withColumn(output, F.element_at(table, F.col("_group") + 1)).drop("_group")

        return label


def merge(points, weights, clusters: int, linkage: str) -> np.ndarray:
    """Cluster numbers of weighted points after merging the closest pair until ``clusters`` are left.

    After a merge the distances to the joint group follow from those to its two parts.
    """
    x = np.asarray(points, dtype=float)
    w = np.asarray(weights, dtype=float)
    count = len(x)
    if count < clusters:
        raise TableError(f"There are only {count} different rows, too few for {clusters} clusters.")
    squares = (x**2).sum(axis=1)
    gap = np.maximum(squares[:, None] + squares[None, :] - 2 * x @ x.T, 0)
    gap = gap * (2 * np.outer(w, w) / np.add.outer(w, w)) if linkage == "ward" else np.sqrt(gap)
    np.fill_diagonal(gap, np.inf)
    owner = np.arange(count)
    alive = np.ones(count, dtype=bool)
    for _ in range(count - clusters):
        a, b = sorted(divmod(int(gap.argmin()), count))
        others = alive.copy()
        others[[a, b]] = False
        to_a, to_b = gap[a, others], gap[b, others]
        if linkage == "ward":
            rest = w[others]
            joint = ((w[a] + rest) * to_a + (w[b] + rest) * to_b - rest * gap[a, b]) / (w[a] + w[b] + rest)
        elif linkage == "average":
            joint = (w[a] * to_a + w[b] * to_b) / (w[a] + w[b])
        else:
            joint = np.maximum(to_a, to_b) if linkage == "complete" else np.minimum(to_a, to_b)
        gap[a, others] = gap[others, a] = joint
        gap[b, :] = gap[:, b] = np.inf
        alive[b] = False
        w[a] += w[b]
        owner[owner == b] = a
    return np.unique(owner, return_inverse=True)[1]
