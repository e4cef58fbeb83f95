"""Exact single linkage of any number of rows: a minimum spanning tree, cut at its longest edges.

1. Points are stored in blocks of neighbours, which are cut once more where a step of their own is far longer than all others.
   Each block yields the spanning tree of its own points.
2. An edge between two blocks can only be in the tree if it is no longer than the longest step of any detour. That step is bounded by
   distances between a few points of each block and the longest edges inside of blocks, so two blocks whose boxes lie
   further apart than that bound are never compared. Of the others only the points within that bound of the other's box are sent
   together. If no edge inside of the two is longer than their boxes are apart, the one shortest edge across is enough; else the spanning
   tree of these points gives the edges across. There are some thousand blocks at most; their boxes are all that the driver sees.
3. Each block contracts its own edges that are in the tree whatever the others look like: those shorter than all edges
   across that one of their sides has. Only the other edges, those across and the ends of both leave the blocks.
4. Among these the tree is found by Boruvka's rounds in Spark: each component takes its shortest edge, the
   components so joined become one, and edges inside of one go. Once no more than :data:`LAST_EDGES` are left, one task ends the work.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from quillframe.errors import TableError
from quillframe.functions.sizing import broadcast_if_small, store

BLOCK_ROWS, MOST_BLOCKS = 1024, 3000
LAST_EDGES = 1 << 20
_LOOKED_AT = 6  # points of a block that bound its distance to others
_CUTS, _FAR = 2, 4  # most cuts of a block, at steps so many times longer than the next
_STRIPE = 256  # points that are measured at once

_EDGE = T.StructType([T.StructField("d", T.DoubleType()), T.StructField("i", T.LongType()), T.StructField("j", T.LongType())])
_BLOCK = T.StructType([
    T.StructField("block", T.LongType()), T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("x", T.BinaryType()),
    T.StructField("box", T.ArrayType(T.DoubleType())), T.StructField("seen", T.ArrayType(T.DoubleType())), T.StructField("longest", T.DoubleType()),
    T.StructField("tree", T.ArrayType(_EDGE)),
])
_OFFER = T.StructType([
    T.StructField("p", T.LongType()), T.StructField("q", T.LongType()), T.StructField("second", T.BooleanType()), T.StructField("one", T.BooleanType()),
    T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("x", T.BinaryType()),
])
_ACROSS = "d double, i long, j long, p long, q long"
_PART = T.StructType([
    T.StructField("block", T.LongType()), T.StructField("fixed", T.ArrayType(_EDGE)), T.StructField("kept", T.ArrayType(_EDGE)),
    T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("roots", T.ArrayType(T.LongType())),
])


def single_linkage(points: DataFrame, clusters: int, block_rows: int | None = None, last_edges: int = LAST_EDGES) -> DataFrame:
    """``x, cluster`` for the different rows of ``points`` (``x``, an array of doubles), clusters numbered from 0 by their smallest row.

    Between clusters of equal distance the edge of the later rows is cut first. The result is stored.
    """
    held = store(points.select("x").distinct().select(F.monotonically_increasing_id().alias("id"), "x"))
    n = held.count()
    if n < clusters:
        raise TableError(f"There are only {n} different rows, too few for {clusters} clusters.")
    blocks = store(_blocks(held, n, block_rows or max(BLOCK_ROWS, -(-n // MOST_BLOCKS))))
    across = store(_across(blocks))
    parts = store(_parts(blocks, across))
    ends = parts.select(F.explode(F.arrays_zip("ids", "roots")).alias("end")).select(F.col("end.ids").alias("id"), F.col("end.roots").alias("root"))
    tree, _ = _contracted(_between(parts.select(F.inline("kept")).unionByName(across.select("d", "i", "j")), ends), last_edges)
    limit = None
    if clusters > 1:
        every = tree.unionByName(parts.select(F.inline("fixed")))
        cut = every.orderBy(F.desc("d"), F.desc("i"), F.desc("j")).limit(clusters - 1).agg(F.min(F.struct("d", "i", "j")).alias("edge")).first()["edge"]
        limit = cut["d"], cut["i"], cut["j"]
        tree = tree.where(F.struct("d", "i", "j") < F.struct(*[F.lit(v).alias(name) for v, name in zip(limit, "dij")]))
    joined = store(blocks.select("block", "ids", "x").join(parts.select("block", "fixed"), "block").mapInArrow(_joiner(limit), "id long, x array<double>, inner long"))
    roots = broadcast_if_small(_contracted(_between(tree, joined.select("id", F.col("inner").alias("root"))), last_edges)[1])
    named = joined.join(roots.withColumnRenamed("id", "inner"), "inner", "left").select("x", F.coalesce("root", "inner").alias("root"))
    first = named.groupBy("root").agg(F.min("x").alias("first")).orderBy("first").limit(clusters + 1).collect()  # one row per cluster
    numbers = points.sparkSession.createDataFrame([(row["root"], c) for c, row in enumerate(first)], "root long, cluster int")
    return store(named.join(F.broadcast(numbers), "root").select("x", "cluster"))


def _between(edges: DataFrame, ends: DataFrame) -> DataFrame:
    """``a, b, edge`` of edges (``d, i, j``) between the components (``id, root``) of their ends."""
    few = broadcast_if_small(store(ends.join(broadcast_if_small(store(edges.select(F.explode(F.array("i", "j")).alias("id")).distinct())), "id")))
    for side, name in (("i", "a"), ("j", "b")):
        edges = edges.join(few.select(F.col("id").alias(side), F.col("root").alias(name)), side)
    return store(edges.where("a <> b").select("a", "b", F.struct("d", "i", "j").alias("edge")))


def _blocks(held: DataFrame, n: int, block_rows: int) -> DataFrame:
    """Points in tiles: slabs along the coordinate of the largest spread, cut along that of the second largest."""
    width = held.agg(F.max(F.size("x"))).first()[0] or 0
    spread = held.agg(*[F.stddev_pop(F.col("x")[i]).alias(f"s{i}") for i in range(width)]).first()
    along = [F.col("x")[int(i)] for i in np.argsort([-(s or 0) for s in spread], kind="stable")[:2]]
    slabs = max(1, round((n / block_rows) ** 0.5))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, held_back, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            held_back.append(batch)
            size += batch.num_rows
            if size >= block_rows:
                table = pa.Table.from_batches(held_back)
                for at in range(0, size - block_rows + 1, block_rows):
                    yield _packed(number, table.slice(at, block_rows))
                    number += _CUTS + 1
                held_back, size = table.slice(size - size % block_rows).to_batches(), size % block_rows
        if size:
            yield _packed(number, pa.Table.from_batches(held_back))

    return held.repartitionByRange(slabs, *along).sortWithinPartitions(*reversed(along)).mapInArrow(pack, _BLOCK)


def _packed(number: int, points: pa.Table) -> pa.RecordBatch:
    """One block, or a few where it has been cut."""
    points = points.combine_chunks()
    ids, x = points["id"].to_numpy(), points["x"].combine_chunks().flatten().to_numpy().reshape(points.num_rows, -1)
    tree = spanning_tree(x)
    d, i, j = _columns(tree)
    piece = _pieces(d, i, j)
    inside = piece[i] == piece[j]
    rows = []
    for k in range(piece.max() + 1):
        of, edges = np.flatnonzero(piece == k), inside & (piece[i] == k)
        mine = x[of]
        seen = mine[np.linspace(0, len(mine) - 1, min(_LOOKED_AT, len(mine))).astype(int)]
        ends = np.sort(np.stack([ids[i[edges]], ids[j[edges]]]), axis=0)
        rows.append((
            number + k, ids[of], mine.tobytes(), np.r_[mine.min(axis=0), mine.max(axis=0)], seen.ravel(), d[edges].max(initial=0.0), (d[edges], *ends),
        ))
    return _batch(rows, _BLOCK)


def _columns(tree: list[tuple[float, int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    table = np.array(tree, np.float64).reshape(-1, 3)
    return table[:, 0], table[:, 1].astype(np.int64), table[:, 2].astype(np.int64)


def _pieces(d: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The piece of each point once a tree is cut at a few edges far longer than all others. Edges lead from earlier points on."""
    longest = np.argsort(-d, kind="stable")[: _CUTS + 1]
    steps = d[longest]
    ratios = steps[:-1] / np.maximum(steps[1:], np.finfo(float).tiny) if len(steps) > 1 else np.zeros(0)
    cut = set(longest[: int(ratios.argmax()) + 1].tolist()) if len(ratios) and ratios.max() >= _FAR else set()
    piece, count = np.zeros(len(d) + 1, np.int64), 0
    if cut:
        for e, (a, b) in enumerate(zip(i.tolist(), j.tolist())):
            count += e in cut
            piece[b] = count if e in cut else piece[a]
    return piece


def _batch(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    """Rows of numbers, bytes, arrays of numbers and edges (three arrays)."""
    edge = pa.struct([("d", pa.float64()), ("i", pa.int64()), ("j", pa.int64())])
    columns = []
    for values, field in zip(zip(*rows), schema.fields):
        if not isinstance(field.dataType, T.ArrayType):
            columns.append(pa.array(list(values), {"long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(), "binary": pa.binary()}[field.dataType.simpleString().replace("bigint", "long")]))
            continue
        edges = field.dataType.elementType == _EDGE
        offsets = np.r_[0, np.cumsum([len(v[0] if edges else v) for v in values])].astype(np.int32)
        if edges:
            inner = pa.StructArray.from_arrays([pa.array(np.concatenate(part), kind.type) for part, kind in zip(zip(*values), edge)], fields=list(edge))
        else:
            inner = pa.array(np.concatenate(values), pa.int64() if isinstance(field.dataType.elementType, T.LongType) else pa.float64())
        columns.append(pa.ListArray.from_arrays(pa.array(offsets), inner))
    return pa.RecordBatch.from_arrays(columns, schema.names)


def _edges(value: pa.ListScalar) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return tuple(value.values.field(name).to_numpy() for name in "dij")


def spanning_tree(x: np.ndarray) -> list[tuple[float, int, int]]:
    """Edges of the minimum spanning tree of a few points, by adding the nearest point each time."""
    n = len(x)
    differ = np.flatnonzero(x.min(axis=0) != x.max(axis=0))
    if len(differ) <= 1:  # on a line along one coordinate each point is joined to the next
        along = x[:, differ[0] if len(differ) else 0]
        order = np.argsort(along, kind="stable")
        return list(zip(np.diff(along[order]).tolist(), order[:-1].tolist(), order[1:].tolist()))
    gap, near, out = np.full(n, np.inf), np.zeros(n, np.int64), np.ones(n, bool)
    tree, last = [], 0
    for _ in range(n - 1):
        out[last] = False
        d = ((x - x[last]) ** 2).sum(axis=1)
        closer = (d < gap) & out
        gap[closer], near[closer] = d[closer], last
        last = int(np.where(out, gap, np.inf).argmin())
        tree.append((float(np.sqrt(gap[last])), int(near[last]), last))
    return tree


def closest_pair(a: np.ndarray, b: np.ndarray) -> tuple[float, int, int]:
    """The shortest distance between points of two sets, and the places of both. Sorted along one coordinate, few are compared."""
    low, high = (np.array([f(a, axis=0), f(b, axis=0)]) for f in (np.min, np.max))
    axis = int((high - low).max(axis=0).argmax())
    apart = np.maximum(np.maximum(low[1] - high[0], low[0] - high[1]), 0) ** 2
    rest = apart.sum() - apart[axis]
    order_a, order_b = np.argsort(a[:, axis], kind="stable"), np.argsort(b[:, axis], kind="stable")
    a, b = a[order_a], b[order_b]
    best, found = np.inf, (0, 0)

    def look(i: np.ndarray, j: np.ndarray) -> None:
        nonlocal best, found
        d = sum((a[i, None, k] - b[None, j, k]) ** 2 for k in range(a.shape[1]))
        at = int(d.argmin())
        if d.flat[at] < best:
            best, found = float(d.flat[at]), (int(i[at // len(j)]), int(j[at % len(j)]))

    look(*(np.unique(np.linspace(0, len(v) - 1, 64).astype(int)) for v in (a, b)))
    for at in range(0, len(a), _STRIPE):
        if best <= apart.sum():
            break
        i = np.arange(at, min(at + _STRIPE, len(a)))
        reach = np.sqrt(max(best - rest, 0) + 1e-12 * best)
        begin, end = np.searchsorted(b[:, axis], [a[i[0], axis] - reach, a[i[-1], axis] + reach + np.spacing(abs(a[i[-1], axis]))], side="right") - [1, 0]
        for part in range(max(0, int(begin)), int(end), 16 * _STRIPE):
            look(i, np.arange(part, min(part + 16 * _STRIPE, int(end))))
    return float(np.sqrt(best)), int(order_a[found[0]]), int(order_b[found[1]])


def _across(blocks: DataFrame) -> DataFrame:
    """Edges between points of different blocks that may be in the tree; ``i`` is in block ``p``, ``j`` in block ``q``."""
    index = blocks.select("block", "box", "seen", "longest").orderBy("block").collect()  # a few times MOST_BLOCKS
    spark = blocks.sparkSession
    numbers, box, longest = (np.array([row[name] for row in index]) for name in ("block", "box", "longest"))
    p, q, bound = _near(index)
    by_q = np.argsort(q, kind="stable")
    shared = spark.sparkContext.broadcast((numbers, box, longest, p, q, bound, by_q))

    def offer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, box, longest, p, q, bound, by_q = shared.value
        width = box.shape[1] // 2
        q_sorted = q[by_q]
        for batch in batches:
            for block, ids, raw in zip(*(batch[name] for name in ("block", "ids", "x"))):
                me, ids = int(np.searchsorted(numbers, block.as_py())), ids.values.to_numpy()
                x = np.frombuffer(raw.as_buffer()).reshape(-1, width)
                pairs = np.r_[np.arange(*np.searchsorted(p, [me, me + 1])), by_q[slice(*np.searchsorted(q_sorted, [me, me + 1]))]]
                rows = []
                for e in pairs.tolist():
                    second = bool(q[e] == me)
                    other = box[p[e] if second else q[e]]
                    apart = np.sqrt((np.maximum(np.maximum(other[:width] - x, x - other[width:]), 0) ** 2).sum(axis=1))
                    near = np.flatnonzero(apart <= bound[e] * (1 + 1e-6))
                    if len(near):
                        one = max(longest[p[e]], longest[q[e]]) <= _apart(box[p[e]], box[q[e]], width)
                        rows.append((int(numbers[p[e]]), int(numbers[q[e]]), second, bool(one), ids[near], x[near].tobytes()))
                    if len(rows) == 64:
                        yield _batch(rows, _OFFER)
                        rows = []
                if rows:
                    yield _batch(rows, _OFFER)

    def cross(pair: pa.Table) -> pa.Table:
        first = {row: at for at, row in enumerate(pair["second"].to_pylist())}
        if len(first) < 2:
            return pa.table({"d": pa.array([], pa.float64()), **{name: pa.array([], pa.int64()) for name in "ijpq"}})
        ids = [pair["ids"][first[side]].values.to_numpy() for side in (False, True)]
        x = [np.frombuffer(pair["x"][first[side]].as_buffer()).reshape(len(ids[side]), -1) for side in (False, True)]
        size = len(ids[0])
        if pair["one"][0].as_py():
            found = [closest_pair(*x)]
        else:
            found = [(d, *((i, j - size) if i < size else (j, i - size))) for d, i, j in spanning_tree(np.concatenate(x)) if (i < size) != (j < size)]
        d, i, j = _columns(found)
        p, q = (np.full(len(d), pair[name][0].as_py()) for name in "pq")
        return pa.table({"d": d, "i": ids[0][i], "j": ids[1][j], "p": pa.array(p, pa.int64()), "q": pa.array(q, pa.int64())})

    return blocks.select("block", "ids", "x").mapInArrow(offer, _OFFER).groupBy("p", "q").applyInArrow(cross, _ACROSS)


def _apart(one: np.ndarray, other: np.ndarray, width: int) -> float:
    """The distance of two boxes, a trifle less so that rounding never makes it too long."""
    gap = np.maximum(np.maximum(one[:width] - other[width:], other[:width] - one[width:]), 0)
    return float(np.sqrt((gap**2).sum())) * (1 - 1e-12)


def _parts(blocks: DataFrame, across: DataFrame) -> DataFrame:
    """The edges of each block that are in the tree, those that may be, and the components of all ends of edges that may be."""

    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, ids, tree, ends in zip(*(batch[name] for name in ("block", "ids", "tree", "ends"))):
                ids, (d, i, j) = np.sort(ids.values.to_numpy()), _edges(tree)
                shortest = np.full(len(ids), np.inf)
                out = np.zeros(0, np.int64)
                if ends.is_valid:
                    out = np.searchsorted(ids, ends.values.field("id").to_numpy())
                    np.minimum.at(shortest, out, ends.values.field("d").to_numpy())
                order = np.lexsort((j, i, d))
                fixed, root = _contract(d, np.searchsorted(ids, i), np.searchsorted(ids, j), order, shortest)
                left = ~fixed
                of = np.unique(np.r_[out, np.searchsorted(ids, i[left]), np.searchsorted(ids, j[left])])
                yield _batch([(block.as_py(), (d[fixed], i[fixed], j[fixed]), (d[left], i[left], j[left]), ids[of], ids[root[of]])], _PART)

    ends = across.select(F.explode(F.array(F.struct(F.col("p").alias("block"), F.col("i").alias("id"), "d"), F.struct(F.col("q").alias("block"), F.col("j").alias("id"), "d"))).alias("end"))
    ends = ends.groupBy("end.block", "end.id").agg(F.min("end.d").alias("d")).groupBy("block").agg(F.collect_list(F.struct("id", "d")).alias("ends"))
    return blocks.select("block", "ids", "tree").join(ends, "block", "left").mapInArrow(contract, _PART)


def _contract(d: np.ndarray, i: np.ndarray, j: np.ndarray, order: np.ndarray, shortest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which edges of a tree, taken in ``order``, no edge out of one of their sides is shorter than, and every point's component by these.

    ``shortest`` has the shortest edge that leads out of the tree from each point.
    """
    fixed, parent, least = np.zeros(len(d), bool), list(range(len(shortest))), shortest.tolist()
    size = [1] * len(parent)

    def find(v: int) -> int:
        while parent[v] != v:
            parent[v] = parent[parent[v]]
            v = parent[v]
        return v

    for e, length, a, b in zip(order.tolist(), d[order].tolist(), i[order].tolist(), j[order].tolist()):
        a, b = find(a), find(b)
        if least[a] >= length or least[b] >= length:
            if size[a] < size[b]:
                a, b = b, a
            parent[b], least[a] = a, min(least[a], least[b])
            size[a] += size[b]
            fixed[e] = True
    return fixed, np.array([find(v) for v in range(len(parent))], np.int64)


def _joiner(limit: tuple[float, int, int] | None):
    """Every point with its component by the contracted edges of its block before ``limit``."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, raw, fixed in zip(*(batch[name] for name in ("ids", "x", "fixed"))):
                ids, (d, i, j) = ids.values.to_numpy(), _edges(fixed)
                if limit is not None:
                    before = (d < limit[0]) | ((d == limit[0]) & ((i < limit[1]) | ((i == limit[1]) & (j < limit[2]))))
                    d, i, j = d[before], i[before], j[before]
                sort = np.argsort(ids)
                _, root = _contract(d, np.searchsorted(ids, i, sorter=sort), np.searchsorted(ids, j, sorter=sort), np.arange(len(d)), np.full(len(ids), np.inf))
                inner = np.empty(len(ids), np.int64)
                inner[sort] = ids[sort][root]
                x = np.frombuffer(raw.as_buffer())
                width = len(x) // len(ids)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(x) + 1, width), pa.int32()), pa.array(x))
                yield pa.RecordBatch.from_arrays([pa.array(ids), lists, pa.array(inner)], ["id", "x", "inner"])

    return join


def _near(index: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs of blocks whose boxes are nearer than the longest step of the best detour known, and that step, sorted by the first."""
    m = len(index)
    box = np.array([row["box"] for row in index])
    width = box.shape[1] // 2
    low, high, longest = box[:, :width], box[:, width:], np.array([row["longest"] for row in index])
    seen = [np.array(row["seen"]).reshape(-1, width) for row in index]
    every, owner = np.concatenate(seen), np.repeat(np.arange(m), [len(s) for s in seen])
    starts = np.r_[0, np.flatnonzero(np.diff(owner)) + 1]

    def step(p: int) -> np.ndarray:
        """A bound on the longest step on a way from anywhere in block p to anywhere in each other."""
        d = np.sqrt(((every[:, None, :] - seen[p][None]) ** 2).sum(axis=2)).min(axis=1)
        return np.maximum(np.minimum.reduceat(d, starts), np.maximum(longest, longest[p]))

    bound = np.zeros((m, m), np.float32)  # the longest step on the best way between two blocks
    reach, via, out = step(0), np.zeros(m, np.int64), np.ones(m, bool)
    out[0] = False
    joined = [0]
    for _ in range(m - 1):
        new = int(np.where(out, reach, np.inf).argmin())
        bound[new, joined] = bound[joined, new] = np.maximum(bound[via[new], joined], np.float32(reach[new]))
        joined.append(new)
        out[new] = False
        d = step(new)
        closer = out & (d < reach)
        reach[closer], via[closer] = d[closer], new
    first, second, steps = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
    for p in range(m - 1):
        apart = np.maximum(np.maximum(low[p + 1 :] - high[p], low[p] - high[p + 1 :]), 0)
        near = np.sqrt((apart**2).sum(axis=1)) <= bound[p, p + 1 :] * (1 + 1e-6)
        q = np.flatnonzero(near) + p + 1
        first.append(np.full(len(q), p))
        second.append(q)
        steps.append(bound[p, q].astype(np.float64))
    return np.concatenate(first), np.concatenate(second), np.concatenate(steps)


def _contracted(now: DataFrame, last_edges: int) -> tuple[DataFrame, DataFrame]:
    """The minimum spanning forest (``d, i, j``) of stored edges between nodes (``a, b, edge``) and ``id, root`` of every node in it."""
    forest, roots = None, None
    while now.count() > last_edges:
        both = now.select(F.col("a").alias("node"), F.col("b").alias("other"), "edge").unionByName(now.select(F.col("b").alias("node"), F.col("a").alias("other"), "edge"))
        best = store(both.groupBy("node").agg(F.min(F.struct("edge", "other")).alias("best")).select("node", "best.edge", "best.other"))
        chosen = best.select("edge").distinct().select("edge.*")
        forest = store(chosen if forest is None else forest.unionByName(chosen))
        # two that chose each other: the smaller one stays; every other component hangs on the one it chose
        back = best.select(F.col("node").alias("other"), F.col("other").alias("back"))
        parent = best.join(back, "other").select("node", F.when((F.col("back") == F.col("node")) & (F.col("node") < F.col("other")), F.col("node")).otherwise(F.col("other")).alias("root"))
        parent = _jumped(store(parent))
        roots = store(parent.withColumnRenamed("node", "id") if roots is None else roots.join(parent.select(F.col("node").alias("root"), F.col("root").alias("next")), "root", "left").select("id", F.coalesce("next", "root").alias("root")))
        for side in "ab":
            now = now.join(parent.select(F.col("node").alias(side), F.col("root").alias("next")), side).withColumn(side, F.col("next")).drop("next")
        ends = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
        now = store(now.where("a <> b").groupBy(*ends).agg(F.min("edge").alias("edge")))
    rest = now.select("a", "b", "edge.*").coalesce(1).mapInArrow(_finish, "kind string, d double, i long, j long")  # at most last_edges
    rest = store(rest)
    tree = rest.where("kind = 'edge'").select("d", "i", "j")
    last = rest.where("kind = 'root'").select(F.col("i").alias("root"), F.col("j").alias("next"))
    if forest is None:
        return tree, last.select(F.col("root").alias("id"), F.col("next").alias("root"))
    return store(forest.unionByName(tree)), store(roots.join(last, "root", "left").select("id", F.coalesce("next", "root").alias("root")))


def _jumped(parent: DataFrame) -> DataFrame:
    """Every node with the root of its tree, by following two steps at once until nothing changes."""
    while True:
        up = parent.select(F.col("node").alias("root"), F.col("root").alias("next"))
        new = store(parent.join(up, "root").select("node", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved")))
        parent = new.select("node", "root")
        if new.where("moved").isEmpty():
            return parent


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The forest of the last edges by taking them in order, and the root of every component in it."""
    held = list(batches)
    if not held:
        return
    table = pa.Table.from_batches(held)
    a, b, d, i, j = (table[name].to_numpy() for name in ("a", "b", "d", "i", "j"))
    names, ends = np.unique(np.r_[a, b], return_inverse=True)
    parent = list(range(len(names)))

    def find(v: int) -> int:
        while parent[v] != v:
            parent[v] = parent[parent[v]]
            v = parent[v]
        return v

    kept = []
    for e in np.lexsort((j, i, d)).tolist():
        u, v = find(int(ends[e])), find(int(ends[len(a) + e]))
        if u != v:
            parent[max(u, v)] = min(u, v)
            kept.append(e)
    kept = np.array(kept, np.int64)
    roots = names[[find(v) for v in range(len(names))]]
    none = np.zeros(len(names))
    yield pa.RecordBatch.from_arrays([
        pa.array(["edge"] * len(kept) + ["root"] * len(names)), pa.array(np.r_[d[kept], none]), pa.array(np.r_[i[kept], names]), pa.array(np.r_[j[kept], roots]),
    ], ["kind", "d", "i", "j"])
