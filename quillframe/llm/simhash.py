"""SimHash near-duplicates: exact linking of fingerprints by a Gray-order hierarchical index.

Distinct fingerprints are keyed by every pair of ``max_bits + 2`` bit blocks: two fingerprints that differ in at most
``max_bits`` bits agree in at least two blocks, so they meet under some key and no link is lost. A key is the masked
bit pattern at the top of a tree. Below it fingerprints lie in the order of their Gray rank, and each inner node holds
the bits that all below it share, less those of its parent. A search goes down from the key, adds up the differing bits
of the nodes and prunes every group whose sum is above ``max_bits``.

The keyed rows are range-partitioned by key and Gray rank. A key that spans partitions, such as that of a very large group
of near copies, is searched within each partition and then between those pairs of partitions whose shared bits leave a
link possible. Each search hands on a spanning star of what it links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from quillframe.functions.sizing import store
from quillframe.llm.common import arrow_schema, column, fresh, slices
from quillframe.llm.components import connected_components

BITS = 64
SEED = 42
FANOUT = 8
PAIRS_AT_ONCE = 1 << 18  # queries times rows that a search may have in memory at worst
EDGES = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def fingerprint(text: bytes, words: int) -> int:
    """The SimHash of one text as an unsigned number."""
    from xxhash import xxh64_intdigest

    parts = text.lower().split()  # on bytes: A-Z only, ASCII white space only
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = list(accumulate(map(len, parts), lambda end, size: end + 1 + size))
    starts = [0, *(end + 1 for end in ends[:-1])]
    count = max(1, len(parts) - words + 1)
    last = ends[words - 1 :] or ends[-1:]
    hashes = np.fromiter((xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts[:count], last)), dtype="<u8", count=count)
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, count, 1 << 16):
        block = hashes[at : at + (1 << 16)]
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > count, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """``ident, fp`` from ``ident, text``: the fingerprint of each whole text as a signed long. NULL is an empty text, which has 0."""
    schema = T.StructType([T.StructField("ident", docs.schema["ident"].dataType), T.StructField("fp", T.LongType())])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = arrow_schema(schema)
        for batch in slices(batches):
            found = np.array([fingerprint((text or "").encode(), words) for text in batch["text"].to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch["ident"].cast(target.field(0).type), pa.array(found)], schema=target)

    return docs.select("ident", "text").mapInArrow(sign, schema)


def gray_rank(bits: Column) -> Column:
    """The place of a bit pattern in the order of the Gray code, shifted so that signed order is right."""
    for shift in (1, 2, 4, 8, 16, 32):
        bits = bits.bitwiseXOR(F.shiftrightunsigned(bits, shift))
    return bits.bitwiseXOR(F.lit(-(1 << 63)))


def block_keys(bits: Column, max_bits: int) -> Column:
    """One key for each pair of blocks: the number of the pair and the bits of both blocks."""
    count = max_bits + 2
    cuts = [BITS * i // count for i in range(count + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    signed = [mask - (1 << BITS) if mask >> 63 else mask for mask in masks]
    return F.array(*[F.struct(F.lit(i).alias("pair"), bits.bitwiseAND(F.lit(signed[a] | signed[b])).alias("shared")) for i, (a, b) in enumerate(combinations(range(count), 2))])


class GrayIndex:
    """Trees over rows that are sorted by group and Gray rank, all groups at once.

    ``levels`` go from the leaves to one root per group. Each has the pattern and mask that its nodes share and the place of
    its children in the level below.
    """

    def __init__(self, rows: np.ndarray, groups: np.ndarray) -> None:
        starts = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]])
        sizes = np.diff(np.r_[starts, len(rows)])
        self.group_of = np.repeat(np.arange(len(starts)), sizes)
        everywhere = ~np.zeros_like(rows)
        self.levels = [(rows, everywhere, np.arange(len(rows)), np.zeros(len(rows), np.int64))]
        both, either = rows, rows
        while len(both) > len(starts):
            place = np.arange(len(both)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            first = np.flatnonzero(place % FANOUT == 0)
            both, either = np.bitwise_and.reduceat(both, first), np.bitwise_or.reduceat(either, first)
            mask = ~(both ^ either)
            self.levels.append((both & mask, mask, first, np.diff(np.r_[first, len(place)])))
            sizes = -(-sizes // FANOUT)

    def near(self, queries: np.ndarray, groups: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of queries and of rows in the query's group that differ in at most ``most`` bits."""
        query, node = np.arange(len(queries)), groups
        pattern, mask, first, count = self.levels[-1]
        summed = np.bitwise_count((queries ^ pattern[node]) & mask[node]).astype(np.int64)
        for below in range(len(self.levels) - 2, -1, -1):
            kept = summed <= most
            query, node, summed = query[kept], node[kept], summed[kept]
            children, known = count[node], mask[node]
            at = np.repeat(first[node] - np.r_[0, np.cumsum(children)[:-1]], children) + np.arange(children.sum())
            query, summed, known = np.repeat(query, children), np.repeat(summed, children), np.repeat(known, children)
            pattern, mask, first, count = self.levels[below]
            node = at
            summed = summed + np.bitwise_count((queries[query] ^ pattern[node]) & mask[node] & ~known)
        kept = summed <= most
        return query[kept], node[kept]


class _Sets:
    """Sets of places that are joined as links come in."""

    def __init__(self, size: int) -> None:
        self.parent = np.arange(size)

    def roots(self, places: np.ndarray) -> np.ndarray:
        found = self.parent[places]
        while not np.array_equal(up := self.parent[found], found):
            found = up
        self.parent[places] = found
        return found

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        a, b = self.roots(a), self.roots(b)
        apart = a != b
        for x, y in set(zip(a[apart].tolist(), b[apart].tolist())):
            while x != self.parent[x]:
                x = int(self.parent[x])
            while y != self.parent[y]:
                y = int(self.parent[y])
            self.parent[max(x, y)] = min(x, y)


def _stars(rows: np.ndarray, groups: np.ndarray, side: np.ndarray | None, most: int) -> pa.RecordBatch:
    """Spanning stars of the links within each group or, with ``side``, of those between its two sides."""
    numbers = np.cumsum(np.r_[True, groups[1:] != groups[:-1]]) - 1
    if side is None:
        index, queries, places = GrayIndex(rows, groups), np.arange(len(rows)), np.arange(len(rows))
        roots = numbers
    else:
        places, queries = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        index = GrayIndex(rows[places], groups[places])
        roots = numbers  # every group has both sides
    sets, block = _Sets(len(rows)), max(16, PAIRS_AT_ONCE // max(1, len(places)))
    for at in range(0, len(queries), block):
        part = queries[at : at + block]
        query, node = index.near(rows[part], roots[part], most)
        sets.link(part[query], places[node])
    top = sets.roots(np.arange(len(rows)))
    moved = top != np.arange(len(rows))
    return pa.RecordBatch.from_arrays([pa.array(rows[moved].view(np.int64)), pa.array(rows[top[moved]].view(np.int64))], names=["a", "b"])


def links(distinct: DataFrame, max_bits: int, rows_per_task: int = 16_384) -> DataFrame:
    """``a, b``: links between the distinct fingerprints ``fp`` that connect all that differ in at most ``max_bits`` bits."""
    keyed = distinct.select("fp", F.explode(block_keys(F.col("fp"), max_bits)).alias("key")).select("key.pair", "key.shared", "fp")
    counted = keyed.groupBy(F.col("pair").alias("p"), F.col("shared").alias("s")).agg(F.count("*").alias("n")).where("n > 1")
    counted = store(counted)
    meeting = store(keyed.join(counted, (F.col("pair") == F.col("p")) & (F.col("shared") == F.col("s"))).select("pair", "shared", gray_rank(F.col("fp")).alias("rank"), "fp"))
    parts = max(1, -(-meeting.count() // rows_per_task), int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = ("pair", "shared", "rank")
    ranged = store(meeting.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()))

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, rows in _whole_groups(batches):
            yield _stars(rows, keys, None, max_bits)

    within = ranged.repartition("part", "pair", "shared").sortWithinPartitions("part", *order).select("part", "pair", "shared", "fp").mapInArrow(inside, EDGES)

    chunks = ranged.groupBy("pair", "shared", "part").agg(F.bit_and("fp").alias("both"), F.bit_or("fp").alias("either"))
    of_key = Window.partitionBy("pair", "shared")
    spanning = store(chunks.withColumn("parts", F.count("*").over(of_key)).where("parts > 1").drop("parts"))
    left, right = (spanning.select("pair", "shared", *[F.col(c).alias(c + side) for c in ("part", "both", "either")]) for side in "12")
    agreed = [F.bitwise_not(F.col("both" + side).bitwiseXOR(F.col("either" + side))) for side in "12"]
    apart = F.bit_count(F.col("both1").bitwiseXOR(F.col("both2")).bitwiseAND(agreed[0]).bitwiseAND(agreed[1]))
    pairs = store(left.join(right, ["pair", "shared"]).where("part1 < part2").where(apart <= max_bits).select("pair", "shared", "part1", "part2"))
    pairs = pairs.toDF("p", "s", "part1", "part2")
    sided = [
        ranged.join(pairs, (F.col("pair") == F.col("p")) & (F.col("shared") == F.col("s")) & (F.col("part") == F.col(mine)))
        .select("pair", "shared", "part1", "part2", F.lit(side).alias("side"), "rank", "fp")
        for side, mine in enumerate(("part1", "part2"))
    ]

    def between(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks().sort_by([("side", "ascending"), ("rank", "ascending")])
        found = _stars(rows["fp"].to_numpy().view(np.uint64), np.zeros(len(rows), np.int64), rows["side"].to_numpy(), max_bits)
        return pa.Table.from_batches([found])

    across = sided[0].union(sided[1]).groupBy("pair", "shared", "part1", "part2").applyInArrow(between, EDGES)
    return within.union(across)


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted rows in portions that end where a key ends: a number per row for its key, and the fingerprints."""
    waiting: list[pa.RecordBatch] = []

    def ready(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        keys = [batch[name].to_numpy() for name in ("part", "pair", "shared")]
        new = reduce(np.logical_or, [key[1:] != key[:-1] for key in keys])
        return np.r_[0, np.cumsum(new)], batch["fp"].to_numpy().view(np.uint64)

    for batch in batches:
        waiting.append(batch)
        joined = pa.Table.from_batches(waiting).combine_chunks().to_batches()[0] if sum(map(len, waiting)) else batch
        keys, _ = ready(joined) if len(joined) else (np.zeros(0), None)
        cut = int(np.searchsorted(keys, keys[-1])) if len(joined) else 0
        if cut:
            yield ready(joined.slice(0, cut))
        waiting = [joined.slice(cut)]
    if waiting and len(waiting[0]):
        yield ready(waiting[0])


def _classes(signed: DataFrame, max_bits: int) -> DataFrame:
    """``of, component`` for each distinct fingerprint: the smallest ``ident`` of all that it is linked with."""
    nodes = store(signed.groupBy("fp").agg(F.min("ident").alias("least")))
    roots = connected_components(links(nodes.select("fp"), max_bits))
    rooted = store(nodes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root")))
    smallest = store(rooted.groupBy(F.col("root").alias("of")).agg(F.min("least").alias("component")))
    return store(rooted.join(smallest, F.col("root") == F.col("of")).select(F.col("fp").alias("of"), "component"))


def simhash_components(docs: DataFrame, *, words: int = 3, max_bits: int = 3) -> DataFrame:
    """``doc_id, fingerprint, component_id``, one row per row of ``docs``.

    NULL and empty texts have fingerprint zero and are linked like any other. Repeated rows come out as often as they
    went in. ``component_id`` is the smallest ``doc_id`` that is not NULL among all rows that links lead to; it is NULL if there
    is none. An empty table gives no rows. Other columns are not read.
    """
    signed = store(fingerprints(docs.select(column(docs, "doc_id").alias("ident"), column(docs, "text", "string").alias("text")), words))
    classes = _classes(signed, max_bits)
    return signed.join(classes, F.col("fp") == F.col("of")).select(
        F.col("ident").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id")
    )


def keep_one_of_each(docs: DataFrame, *, words: int = 3, max_bits: int = 3) -> DataFrame:
    """The rows of ``docs`` with one row for each group of linked texts, all columns kept.

    The row that stays is one with the smallest ``doc_id`` (NULL last), of several the first in the table. ``docs`` must give the
    same rows in the same order when it is read again, as a scan of files does.
    """
    place = fresh(docs, "near_place")
    numbered = docs.withColumn(place, F.monotonically_increasing_id())
    ident = F.struct(column(docs, "doc_id").isNull().alias("last"), column(docs, "doc_id").alias("doc_id"), F.col(place).alias("place"))
    signed = store(fingerprints(numbered.select(ident.alias("ident"), column(docs, "text", "string").alias("text")), words))
    classes = _classes(signed, max_bits)
    removed = signed.join(classes, F.col("fp") == F.col("of")).where(F.col("ident") != F.col("component")).select(F.col("ident.place").alias(place))
    return numbered.join(store(removed), place, "left_anti").select(*docs.columns)
