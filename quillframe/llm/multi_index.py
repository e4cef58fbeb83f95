"""Approximate nearest neighbours with an inverted multi-index.

Each vector is cut in two halves, each half goes to its nearest centroid, and the pair of centroids is the cell of the
vector. The codebooks are fitted on a bounded sample; every row is indexed. A query walks the cells in the order of
its summed distance to both centroids, by a heap over pairs of ranks, until it has met ``first`` rows. Their true distances
give the k-th best so far. How many rows of a cell are nearer than that is expected from the mean and the spread of what lies
between its rows and its centroids. The query walks on through the cells until those left out hold fewer than ``1 - recall``
of ``k`` such rows between them. All entries met are reranked by their true distance. There is no cap on cells or
candidates.

Entries lie in shards of one first centroid, hot ones salted over several, and meet the queries that walk there in
bounded chunks. Each meeting hands on the k nearest of each query.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from quillframe.functions.sizing import store
from quillframe.llm.common import column

PAIRS_AT_ONCE = 1 << 15
FOUND = "uid long, query_id long, vec_id long, score double"


@dataclass
class Codebooks:
    halves: list[np.ndarray]  # centroids of either half
    cut: int

    def distances(self, vectors: np.ndarray) -> list[np.ndarray]:
        """Squared distances of the halves of each vector to the centroids."""
        parts = vectors[:, : self.cut], vectors[:, self.cut :]
        return [np.maximum((p * p).sum(1)[:, None] - 2 * p @ c.T + (c * c).sum(1), 0) for p, c in zip(parts, self.halves)]


@dataclass
class Cells:
    """Of each cell: how many rows, and mean and variance of their squared distance to the centroids."""

    rows: np.ndarray
    mean: np.ndarray
    variance: np.ndarray


def k_means(points: np.ndarray, count: int, rounds: int = 20, seed: int = 7) -> np.ndarray:
    """At most ``count`` centroids of the sample by Lloyd's rounds from rows far apart."""
    points = np.unique(points, axis=0)
    draw = np.random.default_rng(seed)
    centres = points[[draw.integers(len(points))]]
    nearest = ((points - centres[0]) ** 2).sum(1)
    while len(centres) < min(count, len(points)) and nearest.sum() > 0:
        centres = np.vstack([centres, points[draw.choice(len(points), p=nearest / nearest.sum())]])
        nearest = np.minimum(nearest, ((points - centres[-1]) ** 2).sum(1))
    for _ in range(rounds):
        own = ((points * points).sum(1)[:, None] - 2 * points @ centres.T + (centres * centres).sum(1)).argmin(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, points)
        sizes = np.bincount(own, minlength=len(centres))
        moved = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centres)
        if np.allclose(moved, centres):
            break
        centres = moved
    return centres


def walk(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """Pairs of centroids in the order of their summed distance: a heap over pairs of ranks."""
    orders = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    a, b = first[orders[0]].tolist(), second[orders[1]].tolist()
    heap, pushed = [(a[0] + b[0], 0, 0)], {(0, 0)}
    while heap:
        summed, i, j = heapq.heappop(heap)
        yield summed, int(orders[0][i]), int(orders[1][j])
        for step in ((i + 1, j), (i, j + 1)):
            if step[0] < len(a) and step[1] < len(b) and step not in pushed:
                pushed.add(step)
                heapq.heappush(heap, (a[step[0]] + b[step[1]], *step))


def usable(vectors: Column) -> Column:
    """Whether a vector has no NULL or non-finite component and is not all zero."""
    clean = F.forall(vectors, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(clean & F.exists(vectors, lambda x: x != 0), F.lit(False))


def _matrix(batch: pa.RecordBatch | pa.Table, name: str = "vector") -> np.ndarray:
    values = batch[name].combine_chunks() if isinstance(batch, pa.Table) else batch[name]
    return values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(values), -1)


def nearest_neighbours(
    table: DataFrame, *, k: int = 10, every: int = 100, centroids: int = 24, sample_rows: int = 16_384, first: int = 1_000, recall: float = 0.99,
    rows_per_shard: int = 4_096, queries_per_chunk: int = 2_048,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` nearest rows found for every row whose ``vec_id`` is divisible by ``every``.

    ``score`` is the Euclidean distance in double precision of the vectors as given; ties go to the smaller ``vec_id``. Rows with
    the query's ``vec_id`` are its own and no candidates; other repeated rows count one by one, and a repeated query is
    answered once per row. No part is taken by vectors that are NULL, empty, zero, or have a NULL or non-finite component,
    by those of another length than most, and by rows without ``vec_id``. An empty table gives no rows.
    ``sample_rows`` bounds the rows that the codebooks are fitted on.
    """
    spark = table.sparkSession
    vectors = column(table, "embedding").cast("array<double>")
    rows = table.select(column(table, "vec_id").cast("long").alias("vec_id"), vectors.alias("vector"), F.monotonically_increasing_id().alias("uid"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    lengths = rows.groupBy(F.size("vector").alias("length")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "length").limit(1).collect()
    if not lengths:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    length, total = lengths[0]
    rows = rows.where(F.size("vector") == length)
    share = F.pmod(F.xxhash64("vec_id", F.lit("sample")), F.lit(1 << 30)) < int(min(1.0, sample_rows / total) * (1 << 30))
    sample = np.array([row[0] for row in rows.where(share).select("vector").collect()] or [rows.select("vector").first()[0]])
    cut = length // 2
    books = Codebooks([k_means(sample[:, :cut], centroids), k_means(sample[:, cut:], centroids)], cut)
    shared = spark.sparkContext.broadcast(books)
    width = len(books.halves[1])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                far = shared.value.distances(_matrix(batch))
                cells = [d.argmin(1) for d in far]
                rest = sum(d[np.arange(len(d)), c] for d, c in zip(far, cells))
                yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c.astype(np.int32)) for c in cells), pa.array(rest)], names=[*batch.schema.names, "one", "two", "rest"])

    entries = store(rows.mapInArrow(place, "vec_id long, vector array<double>, uid long, one int, two int, rest double"))
    found = entries.groupBy((F.col("one") * width + F.col("two")).alias("cell")).agg(F.count("*"), F.avg("rest"), F.var_pop("rest")).collect()  # a row per pair of centroids
    size = len(books.halves[0]) * width
    cells = Cells(np.zeros(size, np.int64), np.zeros(size), np.zeros(size))
    for cell, count, mean, variance in found:
        cells.rows[cell], cells.mean[cell], cells.variance[cell] = count, mean, variance
    known = spark.sparkContext.broadcast(cells)
    queries = entries.where(F.col("vec_id") % every == 0).select("uid", F.col("vec_id").alias("query_id"), "vector")
    salts = np.maximum(1, -(-cells.rows.reshape(-1, width).sum(1) // rows_per_shard)).tolist()
    sharded = entries.select("one", "two", "vec_id", "vector", F.pmod(F.xxhash64("uid"), F.element_at(F.lit(salts), F.col("one") + 1)).cast("int").alias("salt"))

    start = store(queries.mapInArrow(_begin(shared, known, first, width), "uid long, query_id long, vector array<double>, one int, twos array<int>"))
    begun = store(_meet(sharded, start, salts, k, queries_per_chunk))
    reached = store(_best(begun, k).groupBy(F.col("uid").alias("of")).agg(F.max("score").alias("reached"), F.count("*").alias("have")))
    onward = queries.join(reached, F.col("uid") == F.col("of"), "left").select("uid", "query_id", "vector", F.when(F.col("have") >= k, F.col("reached")).otherwise(float("inf")).alias("reached"))
    rest = store(onward.mapInArrow(_go_on(shared, known, first, width, (1 - recall) * k), "uid long, query_id long, vector array<double>, one int, twos array<int>"))
    answers = _best(begun.union(_meet(sharded, rest, salts, k, queries_per_chunk)), k)
    return answers.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _best(found: DataFrame, k: int) -> DataFrame:
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("uid").orderBy("score", "vec_id")))
    return ranked.where(F.col("rank") <= k)


def _by_first(cells: list[tuple[int, int]]) -> dict[int, list[int]]:
    grouped: dict[int, list[int]] = {}
    for one, two in cells:
        grouped.setdefault(one, []).append(two)
    return grouped


def _probes(batch: pa.RecordBatch, chosen: list[dict[int, list[int]]]) -> pa.RecordBatch:
    """One row for each query and first centroid with the second centroids to look at."""
    at = pa.array([i for i, cells in enumerate(chosen) for _ in cells], pa.int64())
    columns = [batch[name].take(at) for name in ("uid", "query_id", "vector")]
    ones = pa.array([one for cells in chosen for one in cells], pa.int32())
    twos = pa.array([two for cells in chosen for two in cells.values()], pa.list_(pa.int32()))
    return pa.RecordBatch.from_arrays([*columns, ones, twos], names=["uid", "query_id", "vector", "one", "twos"])


def _start(far: tuple[np.ndarray, np.ndarray], cells: Cells, first: int, width: int) -> list[tuple[int, int]]:
    """The cells of the walk up to the one in which ``first`` rows are met."""
    met, chosen = 0, []
    for _, one, two in walk(*far):
        rows = cells.rows[one * width + two]
        if rows:
            chosen.append((one, two))
            met += rows
            if met >= first:
                break
    return chosen


def _begin(shared: Broadcast, known: Broadcast, first: int, width: int):
    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                yield _probes(batch, [_by_first(_start(far, known.value, first, width)) for far in zip(*shared.value.distances(_matrix(batch)))])

    return begin


def _go_on(shared: Broadcast, known: Broadcast, first: int, width: int, missed: float):
    def onward(far: tuple[np.ndarray, np.ndarray], reached: float) -> list[tuple[int, int]]:
        cells = known.value
        done = set(_start(far, cells, first, width))
        summed = (far[0][:, None] + far[1][None, :]).ravel()
        dimensions = sum(c.shape[1] for c in shared.value.halves)
        # rows of a cell lie around the summed distance plus their own to the centroids
        spread = np.sqrt(cells.variance + 4 * summed * cells.mean / dimensions)
        with np.errstate(divide="ignore", invalid="ignore"):
            below = (reached**2 - summed - cells.mean) / np.maximum(spread, 1e-12)
        nearer = cells.rows * np.fromiter((math.erfc(-z / math.sqrt(2)) / 2 for z in below.tolist()), float, len(below))
        for one, two in done:
            nearer[one * width + two] = 0
        order = np.argsort(nearer, kind="stable")
        hopeful = np.zeros(len(nearer), bool)
        hopeful[order[np.cumsum(nearer[order]) > missed]] = True
        last = summed[hopeful].max(initial=-1.0)
        chosen = []
        for at, one, two in walk(*far):
            if at > last:
                break
            if hopeful[one * width + two]:
                chosen.append((one, two))
        return chosen

    def go_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                far = zip(*shared.value.distances(_matrix(batch)))
                yield _probes(batch, [_by_first(onward(f, r)) for f, r in zip(far, batch["reached"].to_pylist())])

    return go_on


def _meet(entries: DataFrame, probes: DataFrame, salts: list[int], k: int, queries_per_chunk: int) -> DataFrame:
    """The ``k`` nearest entries of each query in each shard that it looks at: ``uid, query_id, vec_id, score``."""
    chunks = [1] * len(salts)
    for one, count in probes.groupBy("one").count().collect():  # a row per centroid
        chunks[one] = -(-count // queries_per_chunk)
    last = lambda numbers: F.element_at(F.lit(numbers), F.col("one") + 1) - 1
    left = entries.select("*", F.explode(F.sequence(F.lit(0), last(chunks))).alias("chunk"))
    right = probes.withColumn("chunk", F.pmod(F.xxhash64("uid", F.lit("chunk")), last(chunks) + 1).cast("int")).select("*", F.explode(F.sequence(F.lit(0), last(salts))).alias("salt"))

    def rank(_: tuple, rows: pa.Table, asked: pa.Table) -> pa.Table:
        results: list[list[tuple]] = [[] for _ in range(len(asked))]
        if len(rows) and len(asked):
            points, wanted = _matrix(rows), _matrix(asked)
            ids, twos, own = rows["vec_id"].to_numpy(), rows["two"].to_numpy(), asked["query_id"].to_numpy()
            seek: dict[int, list[int]] = {}
            for i, cells in enumerate(asked["twos"].to_pylist()):
                for two in cells:
                    seek.setdefault(two, []).append(i)
            for two in np.unique(twos).tolist():
                at, who = np.flatnonzero(twos == two), np.array(seek.get(two, []), np.int64)
                step = max(1, PAIRS_AT_ONCE // len(at))
                for begin in range(0, len(who), step):
                    some = who[begin : begin + step]
                    far = np.sqrt(((wanted[some][:, None, :] - points[at][None, :, :]) ** 2).sum(axis=2))
                    for i, scores in zip(some.tolist(), far):
                        other = ids[at] != own[i]
                        near = np.lexsort((ids[at][other], scores[other]))[:k]
                        results[i] = heapq.nsmallest(k, [*results[i], *zip(scores[other][near].tolist(), ids[at][other][near].tolist())])
        number = pa.array([i for i, kept in enumerate(results) for _ in kept], pa.int64())
        return pa.table({
            "uid": asked["uid"].take(number), "query_id": asked["query_id"].take(number),
            "vec_id": pa.array([vec for kept in results for _, vec in kept], pa.int64()), "score": pa.array([score for kept in results for score, _ in kept], pa.float64()),
        })

    keys = ("one", "salt", "chunk")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(rank, FOUND)
