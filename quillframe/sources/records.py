"""Records of delimited files with line breaks in quoted fields, read by many tasks per file.

Whether a line break ends a record depends on whether the quotes before it are even in number, from the beginning of the file on.
So the work goes in three steps, as for any prefix sum:

1. Spark splits the files at line breaks as it likes. Each task writes the lines of its share as chunks of about a megabyte, with the
   parity of their quotes. They are stored, so that chunks stay the same however the files are split when read again.
2. A running sum over the chunks of each file, one small row per chunk and without their text, says which of them begin
   inside a quoted field.
3. Knowing that, each chunk is cut into records on its own. Only the pieces of records that cross an end of a chunk, two at most
   per chunk, are shuffled and put together.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from quillframe.functions.sizing import broadcast_if_small, settle, store

CHUNK_BYTES = 1 << 20
_HANDED_ON = 10_000  # records
_WHOLE, _HEAD, _TAIL, _THROUGH = "whole", "head", "tail", "through"

_CHUNKS = T.StructType([
    T.StructField("file", T.StringType()), T.StructField("block", T.LongType()), T.StructField("chunk", T.LongType()),
    T.StructField("odd", T.BooleanType()), T.StructField("text", T.StringType()),
])
_PIECES = T.StructType([
    T.StructField("file", T.StringType()), T.StructField("block", T.LongType()), T.StructField("chunk", T.LongType()), T.StructField("kind", T.StringType()),
    T.StructField("heading", T.BooleanType()), T.StructField("record", T.StringType()),
])


def quoted_records(spark: SparkSession, paths: list[str], chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``record, heading``: the whole text of every record, and whether it is the first of its file.

    Lines end with a line feed, or a carriage return and a line feed; breaks inside quoted fields are kept as they are. Blank
    records are left out. A quote that is never closed takes all that follows in its file into one record.
    """
    lines = spark.read.option("lineSep", "\n").text(paths)
    lines = lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    chunks = store(lines.mapInArrow(_chunker(chunk_bytes), _CHUNKS))
    before = Window.partitionBy("file").orderBy("block", "chunk").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum(F.col("odd").cast("int")).over(before), F.lit(0)) % 2 == 1
    marks = settle(chunks.select("file", "block", "chunk", inside.alias("inside")))
    marked = chunks.join(broadcast_if_small(marks), ["file", "block", "chunk"])
    wholes = marked.mapInArrow(_cutter(fragments=False), _PIECES).select("record", "heading")
    return wholes.unionByName(_stitched(marked.mapInArrow(_cutter(fragments=True), _PIECES))).where(F.trim(F.translate("record", "\r\n\t", "   ")) != "")


def _chunker(chunk_bytes: int):
    def chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, number, lines, size = None, 0, [], 0

        def written() -> pa.RecordBatch:
            text = "\n".join(lines)
            row = {"file": place[0], "block": place[1], "chunk": number, "odd": text.count('"') % 2 == 1, "text": text}
            return pa.RecordBatch.from_pylist([row], schema=pa.schema([("file", pa.string()), ("block", pa.int64()), ("chunk", pa.int64()), ("odd", pa.bool_()), ("text", pa.string())]))

        for batch in batches:
            for line, file, block in zip(*(batch[name].to_pylist() for name in ("value", "file", "block"))):
                if lines and (place != (file, block) or size > chunk_bytes):
                    yield written()
                    number, lines, size = number + 1 if place == (file, block) else 0, [], 0
                place = (file, block)
                lines.append(line)
                size += len(line) + 1
        if lines:
            yield written()

    return chunk


def cut_records(text: str, inside: bool) -> list[tuple[str, str]]:
    """The records of a chunk and the pieces at its ends, each with its kind. ``inside`` says that the chunk begins within quotes."""
    lines = text.split("\n")
    if not inside and '"' not in text:
        return [(_WHOLE, line) for line in lines]
    pieces, open_, began = [], [], not inside
    for line in lines:
        open_.append(line)
        if line.count('"') % 2:
            inside = not inside
        if not inside:
            pieces.append((_WHOLE if began else _HEAD, "\n".join(open_)))
            open_, began = [], True
    if open_:
        pieces.append((_TAIL if began else _THROUGH, "\n".join(open_)))
    return pieces


def _cutter(fragments: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):  # a batch may hold all chunks of a task, so only one of them is cut at a time
                file, block, chunk, inside, text = (batch[name][at].as_py() for name in ("file", "block", "chunk", "inside", "text"))
                start = block == 0 and chunk == 0
                found = [(kind, start and i == 0, text.removeprefix("﻿") if start and i == 0 else text) for i, (kind, text) in enumerate(cut_records(text, inside))]
                found = [piece for piece in found if (piece[0] != _WHOLE) == fragments]
                types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.string()]
                for begin in range(0, len(found), _HANDED_ON):
                    part = found[begin : begin + _HANDED_ON]
                    columns = [[file] * len(part), [block] * len(part), [chunk] * len(part), *([piece[i] for piece in part] for i in range(3))]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=_PIECES.names)
                del text, found
                pa.default_memory_pool().release_unused()

    return cut


def _stitched(pieces: DataFrame) -> DataFrame:
    """Records that cross ends of chunks. A piece belongs to the last one before it that began a record."""
    place = F.struct("block", "chunk", F.when(F.col("kind") == _TAIL, 1).otherwise(0).alias("late"))  # a head lies before the tail of its chunk
    placed = pieces.withColumn("place", place)
    before = Window.partitionBy("file").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    owned = placed.withColumn("owner", F.last(F.when(F.col("kind") == _TAIL, F.col("place")), ignorenulls=True).over(before))
    parts = F.array_sort(F.collect_list(F.struct("place", "record")))
    joined = owned.groupBy("file", "owner").agg(F.bool_or("heading").alias("heading"), parts.alias("parts"))
    return joined.select(F.array_join(F.col("parts.record"), "\n").alias("record"), "heading")
