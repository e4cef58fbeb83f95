"""Cross-tokenizer alignment: which tokens of two vocabularies cover the same bytes, and how often they do so in the corpus.

Inside a task all work is on Arrow columns: token lists are flattened beside the number of their document, byte lengths are summed
up within each document, the two sides meet in Acero hash joins on document and end offset, and ``Table.group_by`` counts
links per document. Documents are dealt with in blocks, slices of a task's batches. A block names its different id pairs
once, in a table of its own, and its documents hold numbers into that table.

Spark adds up the blocks' partial counts, and returns to each block the totals of its own pairs only. So what is shuffled is
the different pairs of each block and the documents' number lists, never one row per link.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from quillframe.functions.sizing import store
from quillframe.llm.bpe import byte_letters
from quillframe.llm.common import arrow_schema, column, slices

_PRODUCT_ROWS = 1 << 20  # rows of a join of two groups' ids that are held at once


class BytePieces:
    """A byte-level vocabulary in the form ``base64 rank`` per line; strings of special tokens are ordinary text."""

    def __init__(self, ranks: bytes, pattern: str):
        import tiktoken

        vocabulary = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in ranks.splitlines() if line)}
        self._encode = tiktoken.Encoding("given", pat_str=pattern, mergeable_ranks=vocabulary, special_tokens={}).encode_ordinary
        self.bytes = _table({i: token for token, i in vocabulary.items()})

    def encode(self, texts: Sequence[str]) -> list[list[int]]:
        return [self._encode(" " + text) for text in texts]


class SentencePieces:
    """A ``sentencepiece`` model, which puts the leading space there itself."""

    def __init__(self, model: bytes):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = {i: self._model.id_to_piece(i) for i in range(self._model.get_piece_size())}
        self.bytes = _table({i: bytes([int(p[3:5], 16)]) if self._model.is_byte(i) else p.replace("▁", " ").encode() for i, p in pieces.items()})

    def encode(self, texts: Sequence[str]) -> list[list[int]]:
        return self._model.encode(list(texts), num_threads=1)


def _table(texts: dict[int, bytes]) -> pa.Array:
    return pa.array([texts.get(i, b"") for i in range(max(texts) + 1)], pa.binary())


def _tokens(ids: list[list[int]], texts: pa.Array) -> tuple[pa.Table, list[bytes]]:
    """``doc, id, end`` for each token, ``end`` being its byte offset in its document, and the joined bytes of each document."""
    lists = pa.array(ids, pa.list_(pa.int32()))
    doc, flat = pc.cast(pc.list_parent_indices(lists), pa.int64()), pc.list_flatten(lists)
    pieces = texts.take(flat)
    running = pc.cumulative_sum(pc.cast(pc.binary_length(pieces), pa.int64()))
    bounds = np.r_[0, running.to_numpy()][lists.offsets.to_numpy()]  # of the documents, in the bytes of all
    end = pc.subtract(running, pa.array(bounds[:-1]).take(doc))
    joined = memoryview(pieces.buffers()[2] or b"")
    return pa.table({"doc": doc, "id": flat, "end": end}), [bytes(joined[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


def _grouped(a: pa.Table, b: pa.Table) -> tuple[pa.Table, pa.Table]:
    """Both sides with the group of each token: how many shared ends lie before it, over all documents of the block."""
    a, b = (side.append_column(name, pa.array(np.arange(side.num_rows))) for side, name in ((a, "at_a"), (b, "at_b")))
    shared = a.select(["doc", "end", "at_a"]).join(b.select(["doc", "end", "at_b"]), ["doc", "end"], join_type="inner", use_threads=False)
    sides = []
    for side, name in ((a, "at_a"), (b, "at_b")):
        cuts = np.zeros(side.num_rows, np.int64)
        cuts[shared[name].to_numpy()] = 1
        sides.append(side.drop_columns(name).append_column("group", pa.array(np.cumsum(cuts) - cuts)))
    return sides[0], sides[1]


def _links(a: pa.Table, b: pa.Table) -> pa.Table:
    """``doc, a, b, links``: occurrence pairs of tokens in one group, counted per document and id pair.

    A group's different ids meet, with the product of their occurrences, in parts of a bounded number of rows.
    """
    left = a.group_by(["group", "doc", "id"], use_threads=False).aggregate([("end", "count")]).rename_columns(["group", "doc", "a", "times_a"])
    right = b.group_by(["group", "id"], use_threads=False).aggregate([("end", "count")]).rename_columns(["group", "b", "times_b"])
    partners = np.bincount(right["group"].to_numpy())
    parts, held = [], 0
    steps = np.cumsum(partners[left["group"].to_numpy()]) // _PRODUCT_ROWS
    starts = [0, *(np.flatnonzero(np.diff(steps)) + 1).tolist(), left.num_rows]
    for start, end in zip(starts, starts[1:]):
        met = left.slice(start, end - start).join(right, "group", join_type="inner", use_threads=False)
        met = met.append_column("links", pc.multiply(met["times_a"], met["times_b"]))
        parts.append(_summed(met))
        held += parts[-1].num_rows
        if held > 4 * _PRODUCT_ROWS:
            parts = [_summed(pa.concat_tables(parts))]
            held = parts[0].num_rows - 2 * _PRODUCT_ROWS  # so that it is not summed again after each part
    return _summed(pa.concat_tables(parts)) if len(parts) > 1 else parts[0]


def _summed(met: pa.Table) -> pa.Table:
    return met.group_by(["doc", "a", "b"], use_threads=False).aggregate([("links", "sum")]).rename_columns(["doc", "a", "b", "links"])


def align_texts(texts: Sequence[str | None], first, second) -> pa.Table:
    """Alignment of a block of texts, a row each: counts, ``groups``, ``numbers`` and ``links``. The first row carries ``pairs``, the
    different id pairs of the block with their numbers of documents; ``numbers`` are places in it."""
    wanted = [i for i, text in enumerate(texts) if text]
    given = [texts[i] for i in wanted]
    a, bytes_a = _tokens(first.encode(given), first.bytes)
    b, bytes_b = _tokens(second.encode(given), second.bytes)
    fits = [x == y == b" " + text.encode() for x, y, text in zip(bytes_a, bytes_b, given)]
    places = pa.array(wanted, pa.int64())
    if not all(fits):
        keep = pa.array(fits, pa.bool_())
        a, b = a.filter(keep.take(a["doc"])), b.filter(keep.take(b["doc"]))
    a, b = _grouped(*(side.set_column(0, "doc", places.take(side["doc"])) for side in (a, b)))
    links = _links(a, b).sort_by("doc")
    pairs, numbers, documents = np.unique(links["a"].to_numpy().astype(np.int64) << 32 | links["b"].to_numpy(), return_inverse=True, return_counts=True)
    every = np.arange(len(texts) + 1)
    cuts, cuts_a, cuts_b = (np.searchsorted(side["doc"].to_numpy(), every) for side in (links, a, b))
    group_a, group_b = a["group"].to_numpy(), b["group"].to_numpy()
    # ends of documents are shared, so groups are numbered alike on both sides and none reaches over an end
    cuts_g = np.r_[group_a, group_a[-1:] + 1][cuts_a] if len(group_a) else cuts_a
    within = np.arange(cuts_g[-1] + 1)
    written = [_joined(pc.cast(side["id"], pa.string()), np.searchsorted(group, within), ",") for side, group in ((a, group_a), (b, group_b))]
    running = np.r_[0, np.cumsum(links["links"].to_numpy())]
    pair = pa.StructArray.from_arrays([pa.array(pairs >> 32), pa.array(pairs & 0xFFFFFFFF), pa.array(documents)], ["a", "b", "documents"])
    header = np.minimum(every, 1) * len(pairs)
    return pa.table({
        "n_a": np.diff(cuts_a), "n_b": np.diff(cuts_b), "n_groups": np.diff(cuts_g), "n_links": np.diff(running[cuts]),
        "groups": _joined(pc.binary_join_element_wise(*written, "|"), cuts_g, ";"),
        "numbers": _lists(cuts, pa.array(numbers.astype(np.int32))), "links": _lists(cuts, links["links"]), "pairs": _lists(header, pair),
    })


def _lists(cuts: np.ndarray, values: pa.Array | pa.ChunkedArray) -> pa.Array:
    values = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), values)


def _joined(texts: pa.Array | pa.ChunkedArray, cuts: np.ndarray, mark: str) -> pa.Array:
    return pc.binary_join(_lists(cuts, texts), mark)


def align_tokenizers(docs: DataFrame, ranks: bytes, pattern: str, model: bytes, *, with_groups: bool = False) -> DataFrame:
    """Align a byte-level vocabulary (A: ``ranks`` with its splitting ``pattern``) with a ``sentencepiece`` model (B) on every whole text.

    Both encode a space and the text, without special tokens. Byte offsets where tokens of both end cut them into groups; tokens of
    A and B in one group are linked. The count of an id pair is the number of documents of the table that hold it linked.

    One row per document: ``doc_id, n_a, n_b, n_groups, n_links, n_best`` (links whose pair has the highest count of its A id, ties
    included), ``count_sum`` (counts added up over links), ``groups_sha256`` and, if asked for, ``groups`` as text
    (``a1,a2|b1;a3|b2,b3``). NULL and empty texts, and texts that one of the two does not keep byte for byte, have no tokens: zeros and
    an empty text. Rows with a NULL or repeated ``doc_id`` and repeated rows count as documents of their own; very long texts
    are aligned whole, their links counted in bounded parts. An empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    shipped = spark.sparkContext.broadcast((ranks, pattern, model))  # files of fixed size
    pair = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType()), T.StructField("documents", T.LongType())])
    counts = [T.StructField(name, T.LongType()) for name in ("n_a", "n_b", "n_groups", "n_links")]
    schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("doc_id", docs.schema["doc_id"].dataType), *counts, T.StructField("groups_sha256", T.StringType()),
        *([T.StructField("groups", T.StringType())] if with_groups else []),
        T.StructField("numbers", T.ArrayType(T.IntegerType())), T.StructField("links", T.ArrayType(T.LongType())),
        T.StructField("pairs", T.ArrayType(pair)),
    ])

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        content, target = shipped.value, arrow_schema(schema)
        first, second = BytePieces(*content[:2]), SentencePieces(content[2])
        for batch in slices(batches):
            rows = align_texts(batch["text"].to_pylist(), first, second)
            digests = [hashlib.sha256(text.encode()).hexdigest() if text else "" for text in rows["groups"].to_pylist()]
            rows = rows.append_column("groups_sha256", pa.array(digests)).append_column("doc_id", batch["doc_id"])
            rows = rows.append_column("block", pa.array(np.full(len(digests), batch["uid"][0].as_py())))  # named by its first row
            yield from rows.select(target.names).cast(target).combine_chunks().to_batches()

    source = docs.select(
        F.monotonically_increasing_id().alias("uid"), column(docs, "doc_id").alias("doc_id"), F.coalesce(column(docs, "text", "string"), F.lit("")).alias("text")
    )
    aligned = store(source.mapInArrow(align, schema))  # written once: numbers of blocks and pairs stay the same in all that follows
    named = aligned.select(F.col("block").alias("of"), F.posexplode("pairs").alias("number", "pair")).select("of", "number", "pair.*")
    totals = named.groupBy("a", "b").agg(F.sum("documents").alias("total"))
    highest = totals.groupBy("a").agg(F.max("total").alias("highest"))
    judged = totals.join(highest, "a").select("a", "b", "total", (F.col("total") == F.col("highest")).alias("best"))
    returned = named.join(judged, ["a", "b"]).select("of", "number", "total", "best")
    kept = [name for name in schema.names if name not in ("block", "numbers", "links", "pairs")]
    result = T.StructType([schema[name] for name in kept] + [T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])

    def add_up(rows: pa.Table, pairs: pa.Table) -> pa.Table:
        pairs = pairs.sort_by("number")
        total, best = pairs["total"].to_numpy(), pairs["best"].to_numpy()
        numbers, links = (rows[name].combine_chunks() for name in ("numbers", "links"))
        flat, times = numbers.flatten().to_numpy(), links.flatten().to_numpy()
        ends = np.r_[0, np.cumsum(numbers.value_lengths().to_numpy())]
        n_best, sums = (np.r_[0, np.cumsum(times * values[flat])] for values in (best.astype(np.int64), total))
        out = rows.select(kept).append_column("n_best", pa.array(np.diff(n_best[ends]))).append_column("count_sum", pa.array(np.diff(sums[ends])))
        return out.cast(arrow_schema(result))

    return aligned.drop("pairs").groupBy("block").cogroup(returned.groupBy("of")).applyInArrow(add_up, result)
