"""The Euclidean silhouette of any number of rows, by distances between blocks of them.

A row's silhouette compares its mean distance to its own cluster with the least mean distance to another one. Rows are stored in
blocks of neighbours, sorted by cluster. For each block the moments of the clusters tell which of them can be nearest at all: the
mean distance from a row to a cluster is at least the distance to its centre, and at most the root of that, squared, plus the
cluster's variance. Only blocks with rows of such clusters, and of the rows' own, are measured against it. Blocks meet in groups of up to
32 neighbours on either side, so that each is shuffled once for each group that it meets and not for each block. A pair of blocks yields, for
each row asked about, a sum of distances to its own cluster, the least mean of the clusters that lie wholly in the block, and a sum
for those that do not. These add up in any order, in the two groups first and then in two rounds over all.

With up to three features the distances of all pairs are not taken one by one: rows far from each other meet by the boxes that they are in, see
:mod:`quillframe.operators.boxes`, and the work is no longer that of the square of the rows. Equal rows of a cluster are counted once, with their
number. Rows are stored in chunks of neighbours of one cluster, cut into leaves; the trees over all leaves are broadcast, and a task has a chunk
and the leaves near it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from quillframe.errors import TableError
from quillframe.functions.sizing import BROADCAST_BYTES, settle, store
from quillframe.operators import boxes

BLOCK_ROWS = 2048
_FINER = 8  # blocks of drawn rows are smaller by this: their rows then agree better on the clusters that can be nearest
_STRIPE = 256  # rows of a block that are measured at once
_NARROW, _CELLS = 8, 1 << 16  # up to so many features differences are taken, for so many pairs at once: they stay in a core's cache
_TASKS = 4  # tasks for each core that groups of blocks are dealt over
_TOGETHER, _TOGETHER_BYTES = 32, 32 << 20  # most blocks on one side of two groups that meet, and their most bytes unless it is one block
_IN_PARTITION = 8  # blocks that are written by one task
_TREES = 10_000  # most clusters that get a tree each
_FOREST_BYTES = 128 << 20  # of the trees; for more rows than that the leaves are larger
_CHUNK_ROWS, _PART_ROWS, _FEW_ROWS = 1 << 14, 1 << 16, 1 << 12  # different rows of a chunk, and of a task that cuts chunks, unless few tasks have some
_LEAVES = 15  # bits for the number of a leaf in its chunk

_BLOCK = T.StructType([
    T.StructField("block", T.LongType()), T.StructField("codes", T.ArrayType(T.LongType())), T.StructField("sizes", T.ArrayType(T.LongType())), T.StructField("x", T.BinaryType()),
])
_SUM = T.StructType([T.StructField("code", T.LongType()), T.StructField("size", T.LongType()), T.StructField("total", T.ArrayType(T.DoubleType()))])
_PARTIAL = T.StructType([
    T.StructField("q", T.LongType()), T.StructField("size", T.ArrayType(T.LongType())), T.StructField("own", T.ArrayType(T.DoubleType())),
    T.StructField("least", T.ArrayType(T.DoubleType())), T.StructField("sums", T.ArrayType(_SUM)),
])
_CHUNK = T.StructType([
    T.StructField("g", T.LongType()), T.StructField("code", T.LongType()),
    *[T.StructField(name, T.BinaryType()) for name in ("x", "weight", "starts", "low", "high", "grid")],
])


def euclidean_silhouette(points: DataFrame, moments: DataFrame, rows: int | None, block_rows: int = BLOCK_ROWS) -> Column | None:
    """The mean silhouette of ``points`` (``label, x``), or of ``rows`` of them drawn by hash, each against all points; a scalar column.

    ``moments`` has ``label, n, centre, within``. None unless there are two clusters and fewer than points.
    """
    spark = points.sparkSession
    clusters = settle(moments.select("label", "n", "centre", "within", F.xxhash64("label").alias("code")))
    held = clusters.agg(F.count("*").alias("k"), F.sum("n").alias("n"), F.max(F.size("centre")).alias("width"), F.count_distinct("code").alias("codes")).first()
    if not 1 < held["k"] < (held["n"] or 0):
        return None
    if held["codes"] < held["k"] or held["k"] * (held["width"] + 4) * 8 > BROADCAST_BYTES:
        raise TableError(f"The centres of {held['k']} clusters take more than {BROADCAST_BYTES >> 20} MB; use squared_silhouette.")
    coded = points.join(F.broadcast(clusters.select("label", "code", F.col("n").alias("size"))), "label").select("code", "size", "x")
    drawn = rows is not None and held["n"] > rows
    if not drawn and held["width"] in boxes.GRID and held["k"] <= _TREES:
        bounds = _bounds(coded, held["width"])
        if all(np.isfinite(side).all() for side in bounds[1:]):
            return _by_boxes(coded, clusters, bounds, held["n"], block_rows)
    data = store(_blocks(coded, max(1, held["n"] // (_IN_PARTITION * block_rows)), block_rows))
    finer = min(_FINER, block_rows) if drawn else 1
    few = block_rows // finer
    asked = store(_blocks(coded.orderBy(F.xxhash64("code", "x"), "x").limit(rows), 1 + rows // few, few)) if drawn else data
    centres = spark.sparkContext.broadcast(_centres(clusters))
    near = asked.mapInArrow(_candidates(centres), "q long, code long")
    index = data.select("block", F.explode(F.array_distinct("codes")).alias("code"))
    pairs = store(near.join(index, "code").groupBy("q", "block").agg(F.collect_set("code").alias("wanted")))
    # groups of blocks large enough to spare the shuffle, small enough to give every core some
    met, spread = math.ceil(asked.count() / finer) * data.count(), _TASKS * spark.sparkContext.defaultParallelism
    together = max(1, min(_TOGETHER, math.isqrt(met // spread), _TOGETHER_BYTES // (block_rows * held["width"] * 8)))
    questions, answers = _gathered(pairs, asked, data, together, 1 if drawn else _IN_PARTITION, finer)
    # A group takes long for the few bytes that it has, so Spark is told over how many tasks to deal them.
    dealt = [side.repartition(max(1, min(spread, met // together**2)), "g", "s").groupBy("g", "s") for side in (questions, answers)]
    measured = dealt[0].cogroup(dealt[1]).applyInArrow(_measure(held["width"]), _PARTIAL)
    first = measured.groupBy("q", F.pmod(F.xxhash64(F.spark_partition_id()), F.lit(32)).alias("part")).applyInArrow(_add_parts, _PARTIAL)
    scores = first.groupBy("q").applyInArrow(_score, "total double, n long")
    return scores.agg(F.sum("total") / F.sum("n")).scalar()


def _blocks(coded: DataFrame, parts: int, block_rows: int) -> DataFrame:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, held, size = TaskContext.get().partitionId() << 32, [], 0

        def written(table: pa.Table) -> pa.RecordBatch:
            nonlocal number
            table = table.combine_chunks()
            x = table["x"].combine_chunks().flatten().to_numpy().astype(np.float64)
            row = {"block": number, "codes": table["code"].to_pylist(), "sizes": table["size"].to_pylist(), "x": x.tobytes()}
            number += 1
            types = {"block": pa.int64(), "codes": pa.list_(pa.int64()), "sizes": pa.list_(pa.int64()), "x": pa.binary()}
            return pa.RecordBatch.from_pylist([row], schema=pa.schema(types))

        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= block_rows:
                table = pa.Table.from_batches(held)
                for at in range(0, size - size % block_rows, block_rows):
                    yield written(table.slice(at, block_rows))
                held, size = table.slice(size - size % block_rows).to_batches(), size % block_rows
        if size:
            yield written(pa.Table.from_batches(held))

    order = ["code", F.col("x")[0]]
    return coded.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(pack, _BLOCK)


def _centres(clusters: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code, centre and variance of each cluster. Their size has been checked."""
    found = clusters.select("code", "centre", (F.col("within") / F.col("n")).alias("variance")).orderBy("code").collect()
    return np.array([r["code"] for r in found], np.int64), np.array([r["centre"] for r in found]), np.array([r["variance"] for r in found])


def _candidates(centres):
    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, own, raw in zip(*(batch[name].to_pylist() for name in ("block", "codes", "x"))):
                found = _wanted(np.frombuffer(raw).reshape(len(own), -1), own, *centres.value)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), block)), pa.array(found)], ["q", "code"])

    return near


def _wanted(x: np.ndarray, own: Sequence[int], codes: np.ndarray, middle: np.ndarray, variance: np.ndarray) -> np.ndarray:
    """The clusters of the rows, and those that can be nearest to one of them."""
    wanted = np.isin(codes, own)
    place = np.searchsorted(codes, own)
    for at in range(0, len(x), _STRIPE):
        low = _distances(x[at : at + _STRIPE], middle)
        high = np.sqrt(low**2 + variance)
        high[np.arange(len(high)), place[at : at + _STRIPE]] = np.inf
        wanted |= (low <= high.min(axis=1, keepdims=True) * (1 + 1e-9) + 1e-9).any(axis=0)
    return codes[wanted]


def _totals(a: np.ndarray, b: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Distances from each row of ``a`` to the rows of ``b``, added up over the runs of these."""
    if a.shape[1] > _NARROW:
        return np.concatenate([np.add.reduceat(_distances(a[at : at + _STRIPE], b), starts, axis=1) for at in range(0, len(a), _STRIPE)])
    totals, stripe = np.empty((len(a), len(starts))), max(1, _CELLS // len(b))
    room, columns = np.empty((2, stripe, len(b))), np.ascontiguousarray(b.T)
    for at in range(0, len(a), stripe):
        part = a[at : at + stripe]
        squares, more = room[0, : len(part)], room[1, : len(part)]
        np.square(np.subtract(part[:, :1], columns[0], out=squares), out=squares)
        for j in range(1, a.shape[1]):
            squares += np.square(np.subtract(part[:, j, None], columns[j], out=more), out=more)
        np.add.reduceat(np.sqrt(squares, out=squares), starts, axis=1, out=totals[at : at + stripe])
    return totals


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    if a.shape[1] <= _NARROW:
        return np.sqrt(sum((a[:, j, None] - b[None, :, j]) ** 2 for j in range(a.shape[1])))
    middle = b.mean(axis=0)
    a, b = a - middle, b - middle
    return np.sqrt(np.maximum((a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1)[None, :] - 2 * a @ b.T, 0))


class _Partial:
    """What is known of the rows of one block so far."""

    def __init__(self, size: np.ndarray) -> None:
        self.size, self.own, self.least = size, np.zeros(len(size)), np.full(len(size), np.inf)
        self.sums: dict[tuple[int, int], np.ndarray] = {}

    def add(self, own: np.ndarray, least: np.ndarray, sums: dict[tuple[int, int], np.ndarray]) -> None:
        self.own = self.own + own
        self.least = np.minimum(self.least, least)
        for key, total in sums.items():
            self.sums[key] = self.sums[key] + total if key in self.sums else total

    def row(self, q: int) -> dict:
        sums = [{"code": code, "size": size, "total": total} for (code, size), total in self.sums.items()]
        return {"q": q, "size": self.size, "own": self.own, "least": self.least, "sums": sums}


def _group(number: Column, together: int, in_partition: int) -> Column:
    """The group of a block: neighbouring partitions as far as they make up ``together`` blocks, cut where a partition alone holds more."""
    partition, place = F.shiftright(number, 32), number.bitwiseAND(0xFFFFFFFF)
    return F.floor(partition / max(1, together // in_partition)) * (1 << 24) + F.floor(place / together)


def _gathered(pairs: DataFrame, asked: DataFrame, data: DataFrame, together: int, in_partition: int, finer: int = 1) -> tuple[DataFrame, DataFrame]:
    """Blocks asked about, with those to compare them with, and these, each once for every group of the other side, by ``g`` and ``s``."""
    grouped = pairs.select("*", _group(F.col("q"), together * finer, in_partition).alias("g"), _group(F.col("block"), together, _IN_PARTITION).alias("s"))
    asks = grouped.groupBy("q", "g", "s").agg(F.collect_list(F.struct("block", "wanted")).alias("asks"))
    questions = asks.join(asked.withColumnsRenamed({"block": "q", "codes": "q_codes", "sizes": "q_sizes", "x": "q_x"}), "q")
    meets = grouped.select(*[F.col(name).alias(name) for name in ("g", "s", "block")]).distinct()  # columns apart from those of the other side
    return questions, meets.join(data, "block")


def _measure(width: int):
    def measure(questions: pa.Table, answers: pa.Table) -> pa.Table:
        places = {block: i for i, block in enumerate(answers["block"].to_pylist())}

        def points(column: pa.ChunkedArray, i: int) -> np.ndarray:
            return np.frombuffer(column[i].as_buffer()).reshape(-1, width)

        rows = []
        for i in range(questions.num_rows):
            q_codes, q_sizes = (questions[name][i].values.to_numpy() for name in ("q_codes", "q_sizes"))
            part, q_x = _Partial(q_sizes), points(questions["q_x"], i)
            for ask in questions["asks"][i]:
                at = places[ask["block"].as_py()]
                codes, sizes = (answers[name][at].values.to_numpy() for name in ("codes", "sizes"))
                part.add(*_compared(q_codes, q_x, ask["wanted"].values.to_numpy(), codes, sizes, points(answers["x"], at)))
            rows.append(part.row(questions["q"][i].as_py()))
        return pa.Table.from_batches([_rows(rows)])

    return measure


def _compared(q_codes: np.ndarray, q_x: np.ndarray, wanted: np.ndarray, codes: np.ndarray, sizes: np.ndarray, x: np.ndarray):
    """For each row asked about: distances to its own cluster added up, the least mean of whole clusters, and sums for the others.

    Only wanted clusters count: of others not all blocks need be among the pairs.
    """
    counts = np.isin(codes, wanted)
    codes, sizes, x = codes[counts], sizes[counts], x[counts]
    starts = np.r_[0, np.flatnonzero(np.diff(codes)) + 1]
    there = np.diff(np.r_[starts, len(codes)])
    whole = there == sizes[starts]
    totals = _totals(q_x, x, starts)
    own = q_codes[:, None] == codes[starts][None, :]
    least = np.where(own | ~whole, np.inf, totals / sizes[starts]).min(axis=1)
    sums = {(int(codes[starts[j]]), int(sizes[starts[j]])): np.where(own[:, j], np.inf, totals[:, j]) for j in np.flatnonzero(~whole)}
    return np.where(own, totals, 0).sum(axis=1), least, sums


def _rows(rows: list[dict]) -> pa.RecordBatch:
    total = pa.struct([("code", pa.int64()), ("size", pa.int64()), ("total", pa.list_(pa.float64()))])
    types = {"q": pa.int64(), "size": pa.list_(pa.int64()), "own": pa.list_(pa.float64()), "least": pa.list_(pa.float64()), "sums": pa.list_(total)}
    return pa.RecordBatch.from_pylist(rows, schema=pa.schema(types))


def _together(rows: pa.Table) -> tuple[int, _Partial]:
    rows = rows.combine_chunks()
    first = None
    for i in range(rows.num_rows):
        row = {name: rows[name][i] for name in ("size", "own", "least", "sums")}
        if first is None:
            first = _Partial(row["size"].values.to_numpy())
        sums = {(s["code"].as_py(), s["size"].as_py()): s["total"].values.to_numpy() for s in row["sums"]}
        first.add(row["own"].values.to_numpy(), row["least"].values.to_numpy(), sums)
    return rows["q"][0].as_py(), first


def _add_parts(rows: pa.Table) -> pa.Table:
    q, part = _together(rows)
    return pa.Table.from_batches([_rows([part.row(q)])])


def _score(rows: pa.Table) -> pa.Table:
    _, part = _together(rows)
    outer = part.least
    for (_, size), total in part.sums.items():
        outer = np.minimum(outer, total / size)
    values = _values(part.own, part.size, outer)
    return pa.table({"total": [float(values.sum())], "n": pa.array([len(values)], pa.int64())})


def _values(own: np.ndarray, size: np.ndarray, outer: np.ndarray) -> np.ndarray:
    """Silhouettes by the distances to the own cluster added up, its size, and the mean distance to the nearest other one."""
    inner = own / np.maximum(size - 1, 1)
    widest = np.maximum(inner, outer)
    values = np.divide(outer - inner, widest, out=np.zeros(len(inner)), where=widest > 0)
    return np.where(size == 1, 0.0, values)


def _bounds(coded: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code, least and greatest coordinates of each cluster; not a number where one is missing."""
    sides = [F.coalesce(F.col("x")[j], F.lit(float("nan"))) for j in range(width)]
    found = coded.groupBy("code").agg(F.array(*map(F.min, sides)).alias("low"), F.array(*map(F.max, sides)).alias("high")).orderBy("code").collect()
    return np.array([r["code"] for r in found], np.int64), *(np.array([r[side] for r in found], float) for side in ("low", "high"))


def _by_boxes(coded: DataFrame, clusters: DataFrame, bounds: tuple[np.ndarray, np.ndarray, np.ndarray], n: int, leaf: int) -> Column:
    """The mean silhouette of all rows, where there are few features."""
    context, width = coded.sparkSession.sparkContext, bounds[1].shape[1]
    cores, axes = context.defaultParallelism, [f"x{j}" for j in range(width)]
    leaf = max(min(boxes.LEAF[width], leaf), -(-3 * n * boxes.GRID[width] ** width * 8 // _FOREST_BYTES))
    rows = max(leaf, min(_CHUNK_ROWS, n // (_TASKS * cores)))
    alike = coded.groupBy("code", *[F.col("x")[j].alias(axis) for j, axis in enumerate(axes)]).agg(F.count(F.lit(1)).cast("double").alias("weight"))
    keyed = alike.mapInArrow(_placed(context.broadcast(bounds)), T.StructType([*alike.schema, T.StructField("key", T.LongType())]))
    ordered = keyed.repartitionByRange(max(1, n // _PART_ROWS, min(cores, n // _FEW_ROWS)), "code", "key").sortWithinPartitions("code", "key", *axes)
    data = store(ordered.mapInArrow(_chunks(width, leaf, rows), _CHUNK))
    forest = context.broadcast((*_forest(data, width), leaf))
    middle = context.broadcast((*_centres(clusters), dict(clusters.select("code", "n").collect())))
    near = data.select("g", "code", "x").mapInArrow(_near(forest, middle), "g long, block long")
    points = data.select("g", "x", "weight", "starts").mapInArrow(_leaves(width), "block long, x binary, weight binary")
    # A chunk takes long for the few bytes that it has, so Spark is told over how many tasks to deal them.
    tasks = max(1, min(_TASKS * cores, n // leaf), n // (_IN_PARTITION * rows))
    sides = [side.repartition(tasks, "g").groupBy("g") for side in (data.select("g", "code", "x", "weight"), near.join(points, "block"))]
    scores = sides[0].cogroup(sides[1]).applyInArrow(_met(forest, middle), "total double, n double")
    return scores.agg(F.sum("total") / F.sum("n")).scalar()


def _placed(bounds):
    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, low, high = bounds.value
        room = (high - low).max(axis=1)
        for batch in batches:
            at = np.searchsorted(codes, batch["code"].to_numpy())
            x = np.column_stack([batch[f"x{j}"].to_numpy() for j in range(low.shape[1])])
            key = boxes.order((x - low[at]) / np.where(room > 0, room, 1)[at, None], min(31, 62 // x.shape[1]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(key)], [*batch.schema.names, "key"])

    return placed


def _chunks(width: int, leaf: int, most: int):
    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 24

        def written(code: int, x: np.ndarray, weight: np.ndarray) -> pa.RecordBatch:
            nonlocal number
            at, starts = boxes.leaves(x, leaf)
            x, weight = x[at], weight[at]
            parts = list(zip(np.split(x, starts[1:]), np.split(weight, starts[1:])))
            low, high = (np.array([side(part, axis=0) for part, _ in parts]) for side in (np.min, np.max))
            grid = np.array([boxes.grid_weights(*part, *box) for part, *box in zip(parts, low, high)])
            row = {"g": number, "code": code} | {k: v.tobytes() for k, v in (("x", x), ("weight", weight), ("starts", starts), ("low", low), ("high", high), ("grid", grid))}
            number += 1
            types = {name: pa.int64() if name in ("g", "code") else pa.binary() for name in row}
            return pa.RecordBatch.from_pylist([row], schema=pa.schema(types))

        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= most:
                table = pa.Table.from_batches(held)
                done = 0
                for code, x, weight, last in _runs(table, width, most):
                    if not last or len(x) == most:
                        yield written(code, x, weight)
                        done += len(x)
                held, size = table.slice(done).to_batches(), size - done
        if size:
            for code, x, weight, _ in _runs(pa.Table.from_batches(held), width, most):
                yield written(code, x, weight)

    return chunks


def _runs(table: pa.Table, width: int, most: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, bool]]:
    """Rows of one code, at most so many, of a table in the order of codes; the last ones may go on behind it."""
    code, weight = table["code"].to_numpy(), table["weight"].to_numpy()
    x = np.column_stack([table[f"x{j}"].to_numpy() for j in range(width)])
    at = 0
    while at < len(code):
        end = min(at + most, int(np.searchsorted(code, code[at], "right")))
        yield int(code[at]), x[at:end], weight[at:end], end == len(code)
        at = end


def _forest(data: DataFrame, width: int) -> tuple[boxes.Forest, np.ndarray]:
    """The trees over all leaves, whose size has been limited, and the number of each leaf in the table."""
    found = data.select("g", "code", "low", "high", "grid").collect()
    low, high = (np.concatenate([np.frombuffer(r[side]) for r in found]).reshape(-1, width) for side in ("low", "high"))
    grid = np.concatenate([np.frombuffer(r["grid"]) for r in found]).reshape(len(low), -1)
    counts = [len(r["low"]) // (8 * width) for r in found]
    number = np.concatenate([(r["g"] << _LEAVES) + np.arange(count) for r, count in zip(found, counts)])
    return boxes.forest(np.repeat([r["code"] for r in found], counts), low, high, grid), number


def _roots(forest: boxes.Forest, x: np.ndarray, code: int, centres: Sequence[np.ndarray]) -> np.ndarray:
    return np.array([forest.roots[c] for c in _wanted(x, np.full(len(x), code), *centres).tolist()])


def _near(forest, middle):
    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (trees, number, leaf), (*centres, _) = forest.value, middle.value
        for batch in batches:
            for g, code, raw in zip(*(batch[name].to_pylist() for name in ("g", "code", "x"))):
                x = np.frombuffer(raw).reshape(-1, centres[1].shape[1])
                met = [found for _, _, found in boxes.walk(trees, x, _roots(trees, x, code, centres), leaf)]
                block = number[trees.leaf[np.unique(np.concatenate(met))]]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(block), g)), pa.array(block)], ["g", "block"])

    return near


def _leaves(width: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for g, *raw in zip(*(batch[name].to_pylist() for name in ("g", "x", "weight", "starts"))):
                x, weight, starts = np.frombuffer(raw[0]).reshape(-1, width), np.frombuffer(raw[1]), np.frombuffer(raw[2], np.int64)
                parts = [[part.tobytes() for part in np.split(whole, starts[1:])] for whole in (x, weight)]
                yield pa.RecordBatch.from_arrays([pa.array((g << _LEAVES) + np.arange(len(starts))), *(pa.array(part, pa.binary()) for part in parts)], ["block", "x", "weight"])

    return cut


def _met(forest, middle):
    def met(chunks: pa.Table, near: pa.Table) -> pa.Table:
        (trees, number, leaf), (*centres, sizes) = forest.value, middle.value
        width = centres[1].shape[1]
        places = {block: i for i, block in enumerate(near["block"].to_pylist())}

        def points_of(i: int) -> tuple[np.ndarray, np.ndarray]:
            x, weight = (np.frombuffer(near[name][places[number[i]]].as_buffer()) for name in ("x", "weight"))
            return x.reshape(-1, width), weight

        total, n = 0.0, 0.0
        for code, x, weight in zip(chunks["code"].to_pylist(), *(map(np.frombuffer, chunks[name].to_pylist()) for name in ("x", "weight"))):
            x = x.reshape(-1, width)
            sums = boxes.distances_to(trees, x, _roots(trees, x, code, centres), leaf, points_of)
            outer = np.min([found / sizes[c] for c, found in sums.items() if c != code], axis=0)
            total += float(_values(sums[code], np.full(len(x), sizes[code]), outer) @ weight)
            n += float(weight.sum())
        return pa.table({"total": [total], "n": [n]})

    return met
