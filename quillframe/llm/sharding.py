"""Sharding by global byte-size prefix sums.

Rows of sizes, without their texts, are put in order by range partitioning. Each partition's total is one row of an
aggregation; the running sum of those totals is where the partition begins in the whole, and a window inside the
partition does the rest. Each document goes to the shard in which its middle byte falls when all bytes are cut at equal
targets, so shards are contiguous and differ from the target by less than a document at either end.
Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from quillframe.functions.sizing import broadcast_if_small, store
from quillframe.llm.common import column

OVERHEAD = 8  # bytes that a document takes besides its text


def shard_by_bytes(docs: DataFrame, shards: int = 24, *, rows_per_partition: int = 1_000_000) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard``, one row per row of ``docs``.

    The order is that of ``doc_id`` (NULL first); rows with one ``doc_id`` follow in the order of their text's hash and
    then of the table, so that a repeated ``doc_id`` is spread over partitions like any other. Size is the UTF-8 bytes of
    the text (NULL: none) plus 8. The law is ``bytes``; ``grown_shard`` is NULL, as a further shard would move all cuts. An
    empty table gives no rows. ``rows_per_partition`` is the size aimed at, whatever the table: rows of some 40 bytes.
    """
    text = F.coalesce(column(docs, "text", "string"), F.lit(""))
    sized = docs.select(
        column(docs, "doc_id").alias("doc_id"), (F.octet_length(text) + OVERHEAD).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.xxhash64(text).alias("digest"), F.monotonically_increasing_id().alias("place"),
    )
    parts = max(1, -(-docs.count() // rows_per_partition), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = ("doc_id", "digest", "place")
    # stored, so that the numbers of the partitions are settled before they are summed
    ranged = store(sized.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()))
    totals = ranged.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    begins = store(totals.select(
        F.col("part").alias("of"), F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"), F.sum("bytes").over(everything).alias("all_bytes"),
    ))
    inside = Window.partitionBy("part").orderBy(*order)
    placed = (
        ranged.withColumn("end", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0))).withColumn("row", F.row_number().over(inside) - 1)
        .join(broadcast_if_small(begins), F.col("part") == F.col("of"))  # a row of numbers per partition
        .select(
            "doc_id", "size", "text_crc32", (F.col("row") + F.col("rows_before")).alias("row"),
            F.expr(f"CAST((2 * (bytes_before + end) - size) * {int(shards)} DIV (2 * all_bytes) AS INT)").alias("shard"),
        )
    )
    placed = store(placed)
    firsts = store(placed.groupBy(F.col("shard").alias("in_shard")).agg(F.min("row").alias("first")))
    return placed.join(F.broadcast(firsts), F.col("shard") == F.col("in_shard")).select(  # a row per shard
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("row") - F.col("first")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
