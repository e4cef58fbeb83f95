"""Packing documents into training sequences: first-fit decreasing in randomised groups.

Every document is tokenised once, on its scan. It is cut at multiples of the sequence length; the whole pieces fill a
sequence each, and the rests of a group of documents are packed by first-fit decreasing. The open bins of a group are
the leaves of a tournament tree whose inner nodes hold the largest free capacity below, so that the first bin with room
is found in one descent. Groups are drawn by hash and have ``docs_per_group`` documents on average at every size of the
table, so no group grows with it and the padding, at most a few sequences per group, stays a fixed small share.
"""

from __future__ import annotations

import base64
import zlib
import re
from collections.abc import Callable, Iterator, Mapping
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from quillframe.llm.common import arrow_schema, column, slices

END = 0  # the id that ends each document


@lru_cache(maxsize=4)
def _encoding(ranks: bytes, pattern: str):
    import tiktoken

    pairs = (line.split() for line in ranks.splitlines() if line)
    return tiktoken.Encoding("given", pat_str=pattern, mergeable_ranks={base64.b64decode(token): int(rank) for token, rank in pairs}, special_tokens={})


def first_fit_decreasing(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The bin of each size. Larger sizes go first, ties in the order given, each into the first bin with room."""
    leaves = 1 << max(0, int(len(sizes) - 1).bit_length())
    room = [capacity] * (2 * leaves)
    bins = np.zeros(len(sizes), dtype=np.int64)
    for item in np.argsort(-sizes, kind="stable").tolist():
        size, node = int(sizes[item]), 1
        while node < leaves:
            node *= 2
            if room[node] < size:
                node += 1
        bins[item] = node - leaves
        room[node] -= size
        while node > 1:
            node //= 2
            room[node] = max(room[2 * node], room[2 * node + 1])
    return bins


def _place(group: int, tokens: np.ndarray, length: int) -> dict[str, np.ndarray]:
    """The pieces of the documents of one group: row of the document, start, length, sequence and offset."""
    whole, rest = tokens // length, tokens % length
    owner = np.repeat(np.arange(len(tokens)), whole)
    number = np.arange(whole.sum()) - np.repeat(np.cumsum(whole) - whole, whole)
    tails = np.flatnonzero(rest)
    bins = first_fit_decreasing(rest[tails], length)
    order = np.lexsort((tails, -rest[tails], bins))
    tails, bins = tails[order], bins[order]
    sizes = rest[tails]
    ends = np.cumsum(sizes)
    first = np.r_[True, bins[1:] != bins[:-1]] if len(bins) else np.zeros(0, bool)
    base = (ends - sizes)[np.maximum.accumulate(np.where(first, np.arange(len(bins)), 0))] if len(bins) else sizes
    return {
        "row": np.r_[owner, tails],
        "start": np.r_[number * length, whole[tails] * length],
        "length": np.r_[np.full(len(owner), length), sizes],
        "sequence_id": (np.int64(group) << 32) + np.r_[np.arange(len(owner)), len(owner) + bins],
        "offset": np.r_[np.zeros(len(owner), np.int64), ends - sizes - base],
    }


def pack_documents(
    docs: DataFrame, ranks: bytes, pattern: str, *, added: Mapping[str, int] | None = None, length: int = 1024, docs_per_group: int = 2048, seed: int = 42, with_ids: bool = False
) -> DataFrame:
    """Pack documents into sequences of at most ``length`` tokens.

    ``ranks`` is the content of a vocabulary file of byte-level pairs (one ``base64 rank`` per line) and ``pattern`` its
    splitting pattern; they are shipped to the tasks, which need no file. ``added`` has the vocabulary's added tokens: their strings
    in a text become their own id. The ids are those that the ``tokenizers`` library gives for the same vocabulary; id 0 ends each document.

    One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` and, if asked for, ``ids``.
    A NULL or empty text is a document of the one id 0. Repeated rows and NULL ``doc_id`` are packed like any other
    row, each on its own. Very long texts are tokenised whole and cut. An empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    added = dict(added or {})
    groups = max(1, -(-docs.count() // docs_per_group))
    narrow = "<u2" if max([ranks.count(b"\n"), *added.values()]) < 1 << 16 else "<u4"
    vocabulary = spark.sparkContext.broadcast(ranks)  # a file of fixed size
    piece = T.StructType([T.StructField("crc", T.LongType()), T.StructField("ids", T.BinaryType())])
    schema = T.StructType([
        T.StructField("uid", T.LongType()), T.StructField("doc_id", docs.schema["doc_id"].dataType),
        T.StructField("doc_tokens", T.LongType()), T.StructField("pieces", T.ArrayType(piece)),
    ])
    source = docs.select(
        F.monotonically_increasing_id().alias("uid"), column(docs, "doc_id").alias("doc_id"), F.coalesce(column(docs, "text", "string"), F.lit("")).alias("text")
    )
    tokenised = source.mapInArrow(_tokeniser(vocabulary, pattern, added, schema, length, narrow, with_ids), schema)
    grouped = tokenised.withColumn("group", F.pmod(F.xxhash64("uid", F.lit(seed)), F.lit(groups)))
    packed = T.StructType([schema["doc_id"], *(T.StructField(name, T.LongType()) for name in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"))])
    if with_ids:
        packed = packed.add("ids", T.ArrayType(T.IntegerType()))

    def pack(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks().sort_by("uid")
        placed = _place(key[0].as_py(), rows["doc_tokens"].to_numpy(), length)
        row = pa.array(placed.pop("row"))
        starts = rows["pieces"].combine_chunks().offsets.to_numpy()
        parts = rows["pieces"].combine_chunks().flatten().take(pa.array(starts[row.to_numpy()] + placed["start"] // length))
        columns = {"doc_id": rows["doc_id"].take(row), "doc_tokens": rows["doc_tokens"].take(row), "ids_crc32": parts.field("crc"), **placed}
        if with_ids:
            columns["ids"] = pa.array([np.frombuffer(ids, narrow).astype(np.int32) for ids in parts.field("ids").to_pylist()], pa.list_(pa.int32()))
        return pa.table([columns[name] for name in packed.names], names=packed.names).cast(arrow_schema(packed))

    return grouped.groupBy("group").applyInArrow(pack, packed)


def _tokeniser(vocabulary, pattern: str, added: dict[str, int], schema: T.StructType, length: int, narrow: str, with_ids: bool) -> Callable:
    cut = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(vocabulary.value, pattern).encode_ordinary
        target = arrow_schema(schema)
        for batch in slices(batches):
            counts, pieces = [], []
            for text in batch["text"].to_pylist():
                ids = np.array([*(_with_added(text, cut, added, encode) if cut and cut.search(text) else encode(text)), END], dtype="<u4")
                cuts = [ids[at : at + length] for at in range(0, len(ids), length)]
                counts.append(len(ids))
                pieces.append([{"crc": zlib.crc32(cut.tobytes()), "ids": cut.astype(narrow).tobytes() if with_ids else None} for cut in cuts])
            yield pa.RecordBatch.from_arrays([batch["uid"], batch["doc_id"].cast(target.field(1).type), pa.array(counts, target.field(2).type), pa.array(pieces, target.field(3).type)], schema=target)

    return tokenise


def _with_added(text: str, cut: re.Pattern, added: dict[str, int], encode: Callable[[str], list[int]]) -> list[int]:
    """The ids of a text that is cut at added tokens before anything else."""
    ids, at = [], 0
    for match in cut.finditer(text):
        ids += [*encode(text[at : match.start()]), added[match.group()]]
        at = match.end()
    return ids + encode(text[at:])
