"""Document fingerprints as invertible Bloom lookup sketches of paragraph digests.

A text is cut into paragraphs: its lines, long ones in pieces of ``PIECE`` words. Each paragraph, with the number of times
it came before, has a 64-bit digest that is folded into three cells of a small table (count, exclusive or of the digests
and of their checks). Two tables are subtracted cell by cell; what the texts share cancels out, and peeling cells with a
single digest left gives the differing digests one after the other. If peeling gets stuck, the tables are made again
twice as large until it succeeds. The likeness of two texts is the share of their digests that do not differ.

The neighbour of a document is found by range partitioning in the order of ``doc_id``: the one shuffle of whole texts. Within
a partition documents pass by in order; only the first and the last of each partition are joined afterwards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from quillframe.functions.sizing import store
from quillframe.llm.common import arrow_schema, column, slices

CELLS = 15  # of a fingerprint, and of the first try at a difference
HASHES = 3
PIECE = 16
PAIRS_AT_ONCE = 256
FIELDS = ("n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def digests(text: str) -> np.ndarray:
    """The digests of the paragraphs of a text, all different."""
    from xxhash import xxh64_intdigest

    seen: dict[str, int] = {}
    found = []
    for line in text.split("\n"):
        words = line.split()
        for at in range(0, len(words), PIECE):
            piece = " ".join(words[at : at + PIECE])
            before = seen.get(piece, 0)
            seen[piece] = before + 1
            found.append(xxh64_intdigest(piece.encode("utf-8", "surrogatepass"), before))
    return np.unique(np.array(found, dtype=np.uint64))


def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A second hash of the digests for each seed."""
    keys = (keys ^ np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))) * np.uint64(0xBF58476D1CE4E5B9)
    keys = (keys ^ (keys >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return keys ^ (keys >> np.uint64(32))


def _places(keys: np.ndarray, cells: int) -> np.ndarray:
    """The cells of each digest, one in each third of the table."""
    third = cells // HASHES
    return np.stack([(_mixed(keys, cells + i) % np.uint64(third)).astype(np.int64) + i * third for i in range(HASHES)], axis=1)


def _check(keys: np.ndarray) -> np.ndarray:
    return _mixed(keys, 7) >> np.uint64(40)


class Tables:
    """Tables of many texts side by side: ``owner`` says to which of ``count`` tables a digest belongs."""

    def __init__(self, keys: np.ndarray, owner: np.ndarray, count: int, cells: int) -> None:
        self.cells = cells
        self.counts = np.zeros(count * cells, np.int64)
        self.keys = np.zeros(count * cells, np.uint64)
        self.checks = np.zeros(count * cells, np.uint64)
        self.fold(keys, owner, np.ones(len(keys), np.int64))

    def fold(self, keys: np.ndarray, owner: np.ndarray, signs: np.ndarray) -> None:
        at = (_places(keys, self.cells) + (owner * self.cells)[:, None]).ravel()
        np.add.at(self.counts, at, np.repeat(signs, HASHES))
        np.bitwise_xor.at(self.keys, at, np.repeat(keys, HASHES))
        np.bitwise_xor.at(self.checks, at, np.repeat(_check(keys), HASHES))

    def minus(self, other: Tables) -> Tables:
        self.counts = self.counts - other.counts
        self.keys = self.keys ^ other.keys
        self.checks = self.checks ^ other.checks
        return self

    def peel(self) -> tuple[np.ndarray, np.ndarray]:
        """How many digests came out of each table, and which tables are empty then."""
        count = len(self.counts) // self.cells
        out = np.zeros(count, np.int64)
        while True:
            single = np.flatnonzero(np.abs(self.counts) == 1)
            single = single[self.checks[single] == _check(self.keys[single])]
            if not len(single):
                break
            owner, keys, signs = single // self.cells, self.keys[single], self.counts[single]
            home = (_places(keys, self.cells) + (owner * self.cells)[:, None] == single[:, None]).any(axis=1)
            owner, keys, signs = owner[home], keys[home], signs[home]
            if not len(keys):
                break
            _, first = np.unique(np.stack([owner.astype(np.uint64), keys]), axis=1, return_index=True)
            owner, keys, signs = owner[first], keys[first], signs[first]
            self.fold(keys, owner, -signs)
            out += np.bincount(owner, minlength=count)
        used = (self.counts != 0) | (self.keys != 0)
        return out, ~used.reshape(count, self.cells).any(axis=1)

    def written(self) -> list[bytes]:
        """Each table as bytes: of every cell two of the count, eight of the digests, three of the checks."""
        cells = np.zeros((len(self.counts), 13), np.uint8)
        cells[:, :2] = self.counts.astype("<u2").view(np.uint8).reshape(-1, 2)
        cells[:, 2:10] = self.keys.astype("<u8").view(np.uint8).reshape(-1, 8)
        cells[:, 10:] = self.checks.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :3]
        size = self.cells * 13
        data = cells.tobytes()
        return [data[at : at + size] for at in range(0, len(data), size)]


def _flat(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate([np.zeros(0, np.uint64), *sets]), np.repeat(np.arange(len(sets)), [len(s) for s in sets])


def differences(left: list[np.ndarray], right: list[np.ndarray], cells: int = CELLS) -> np.ndarray:
    """For each pair the number of digests that only one of both has, by subtracting and peeling, larger on failure."""
    result, open_ = np.zeros(len(left), np.int64), np.arange(len(left))
    while len(open_):
        tables = [Tables(*_flat([side[i] for i in open_]), len(open_), cells) for side in (left, right)]
        found, done = tables[0].minus(tables[1]).peel()
        result[open_[done]] = found[done]
        open_ = open_[~done]
        cells *= 2
    return result


def likeness(left: list[np.ndarray], right: list[np.ndarray]) -> list[float]:
    """The share of digests that both have, 1 for two texts without any."""
    both = np.array([len(a) + len(b) for a, b in zip(left, right)])
    return np.where(both > 0, 1 - differences(left, right) / np.maximum(both, 1), 1.0).tolist()


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as much of the beginning of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _described(texts: list[str], following: list[str]) -> list[list]:
    """The fields of each text."""
    columns: list[list] = [[] for _ in FIELDS]
    for at in range(0, len(texts), PAIRS_AT_ONCE):
        part, after = texts[at : at + PAIRS_AT_ONCE], following[at : at + PAIRS_AT_ONCE]
        versions = [edited(a, b) for a, b in zip(part, after)]
        own, new, following_ = ([digests(t) for t in side] for side in (part, versions, after))
        made = (
            [len(t) for t in part], [hashlib.sha256(v.encode()).hexdigest() for v in versions],
            Tables(*_flat(own), len(own), CELLS).written(), Tables(*_flat(new), len(new), CELLS).written(), likeness(own, new), likeness(own, following_),
        )
        for kept, values in zip(columns, made):
            kept += values
    return columns


def fingerprint_versions(docs: DataFrame, *, bytes_per_partition: int = 32 << 20) -> DataFrame:
    """``doc_id`` and, of its text and of the text that is edited with the next document's, the fields of ``FIELDS``.

    The next document is the one with the next larger ``doc_id`` (NULL first); rows with one ``doc_id`` follow in the order of
    their text's hash and then of the table. After the last comes the first, and a table of one row is followed by that
    row. A NULL text is empty. Texts without words have no digests, an empty sketch and likeness 1 among each other.
    Repeated rows come out as often as they went in. An empty table gives no rows. Other columns are not read.
    """
    text = F.coalesce(column(docs, "text", "string"), F.lit(""))
    source = docs.select(column(docs, "doc_id").alias("doc_id"), text.alias("text"))
    size = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // bytes_per_partition), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = source.withColumns({"digest": F.xxhash64("text"), "place": F.monotonically_increasing_id()}).repartitionByRange(parts, "doc_id", "digest", "place")
    ordered = ranged.sortWithinPartitions("doc_id", "digest", "place").select(F.spark_partition_id().alias("part"), "doc_id", "text")
    described = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("n_chars", T.LongType()), T.StructField("edited_sha256", T.StringType()),
        *(T.StructField(name, T.BinaryType()) for name in FIELDS[2:4]),
        *(T.StructField(name, T.DoubleType()) for name in FIELDS[4:]),
    ])
    edges = [T.StructField("part", T.IntegerType()), T.StructField("edge", T.StringType()), T.StructField("text", T.StringType())]
    schema = T.StructType([*described.fields, *edges])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = arrow_schema(schema)
        waiting = None  # the last document, which has not met its next yet
        for batch in slices(batches):
            ids, texts = batch["doc_id"].cast(target.field(0).type), batch["text"].to_pylist()
            if waiting is None:
                yield _edge(target, batch["part"], ids, texts, 0, "first")
            else:
                ids, texts = pa.concat_arrays([waiting[0], ids]), [waiting[1], *texts]
            last = len(texts) - 1
            if last:
                made = _described(texts[:-1], texts[1:])
                none = [pa.nulls(last, f.type) for f in list(target)[-3:]]
                yield pa.RecordBatch.from_arrays([ids.slice(0, last), *(pa.array(m, f.type) for m, f in zip(made, list(target)[1:])), *none], schema=target)
            waiting = ids.slice(last), texts[-1], batch["part"]
        if waiting is not None:
            yield _edge(target, waiting[2], waiting[0], [waiting[1]], 0, "last")

    walked = store(ordered.mapInArrow(walk, schema))
    firsts = walked.where("edge = 'first'").select("part", F.col("text").alias("following"))
    lasts = walked.where("edge = 'last'").select("part", "doc_id", "text")
    turn = Window.orderBy("part")  # a number per partition
    after = store(firsts.select("part").select("part", F.coalesce(F.lead("part").over(turn), F.min("part").over(Window.partitionBy())).alias("after")))
    ends = lasts.join(after, "part").join(firsts.withColumnRenamed("part", "after"), "after").select("doc_id", "text", "following")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = arrow_schema(described)
        for batch in slices(batches):
            made = _described(batch["text"].to_pylist(), batch["following"].to_pylist())
            yield pa.RecordBatch.from_arrays([batch["doc_id"].cast(target.field(0).type), *(pa.array(m, f.type) for m, f in zip(made, list(target)[1:]))], schema=target)

    everything = walked.where("edge IS NULL").select(*described.names).union(ends.mapInArrow(meet, described))
    return everything.withColumns({name: F.lower(F.hex(name)) for name in FIELDS[2:4]})


def _edge(target: pa.Schema, part: pa.Array, ids: pa.Array, texts: list[str], at: int, edge: str) -> pa.RecordBatch:
    middle = [pa.nulls(1, f.type) for f in list(target)[1:-3]]
    tail = [part.slice(0, 1).cast(target.field("part").type), pa.array([edge], pa.string()), pa.array([texts[at]], pa.string())]
    return pa.RecordBatch.from_arrays([ids.slice(at, 1), *middle, *tail], schema=target)
