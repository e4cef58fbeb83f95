"""Writing intermediate tables, and broadcasting behind a measured size."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quillframe.session import checkpoint_root, scratch_path

BROADCAST_BYTES = 64 << 20


def settle(df: DataFrame) -> DataFrame:
    """Checkpoint a small derived table, so that later uses read it instead of rebuilding it."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def store(df: DataFrame) -> DataFrame:
    """Write a table of any size below the checkpoint folder as Parquet, of which later uses read only the columns they need."""
    path = scratch_path(df.sparkSession, "stored")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(settled: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a settled table for broadcast if its measured size is below ``limit``; else leave the choice to Spark.

    The measure is the length of the rows as JSON, which is above what they take in memory as rows of numbers
    and short texts.
    """
    size = settled.agg(F.sum(F.octet_length(F.to_json(F.struct(*settled.columns))))).first()[0] or 0
    return F.broadcast(settled) if size <= limit else settled
