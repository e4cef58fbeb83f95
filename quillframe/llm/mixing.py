"""Mixing sources to target weights: repetition rates from token totals, then whole copies plus one seeded draw.

The totals are one aggregation of a row per source. The target of a source is its share by weight, but never more than
``most`` times what it has; what is cut off goes to the others by weight until no target is above its limit. Documents
are then repeated where they lie: ``floor(rate)`` copies, and one more where the hash of the document falls below the
fraction. No document meets another, so a hot source is no hot task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from quillframe.functions.hashing import seeded_hash
from quillframe.functions.sizing import broadcast_if_small, store
from quillframe.llm.common import column, fresh

WORD = r"[^\x20\x09-\x0D]+"
_HEX = 13  # digits of the hash that are compared: 52 bits, exact as a double


def word_count(text: Column) -> Column:
    """Runs of characters other than ASCII white space; none in NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """``source, source_size, target`` from one row of ``source, source_size`` per source.

    Sources take the weights in turn in the order of their code points, NULL last. The level that all unlimited
    sources have per weight follows from the sources sorted by limit per weight: at the first source for which what is left,
    spread over the weights from there on, stays within its limit; later ones give lower levels.
    """
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source"))
    ranked = sizes.withColumn("weight", F.element_at(cycle, ((place - 1) % len(weights) + 1).cast("int")))
    limited = ranked.withColumn("limit", F.col("source_size") * F.lit(float(most))).withColumn("full_at", F.col("limit") / F.col("weight"))
    by_level = Window.orderBy("full_at", F.col("source").isNull(), "source")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    levels = limited.select(
        "*",
        (F.sum("source_size").over(whole) * F.lit(float(share)) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))).alias("left"),
        (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))).alias("open"),
    ).withColumn("level", F.col("left") / F.col("open"))
    level = F.max(F.when(F.col("level") <= F.col("full_at"), F.col("level"))).over(whole)
    return levels.withColumn("first_level", level).select("source", "source_size", F.least("limit", F.coalesce(F.col("first_level") * F.col("weight"), "limit")).alias("target"))


def copies_of(rate: Column, keys: Sequence[str], seed: int) -> Column:
    """``floor(rate)``, and one more if the document's hash is below the fraction of the rate."""
    drawn = F.conv(F.substring(seeded_hash(keys, seed), 1, _HEX), 16, 10).cast("double") / float(16**_HEX)
    return (F.floor(rate) + F.when(drawn < rate - F.floor(rate), 1).otherwise(0)).cast("long")


def plan_mix(docs: DataFrame, *, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 42) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies`` for each document.

    The draw depends on ``doc_id`` and the seed, so reruns agree, and repeated rows with one ``doc_id`` share a draw.
    Size is the number of words; a NULL text has none. A NULL source is a source of its own. Sources without words have
    target and copies 0. An empty table gives no rows.
    """
    sized = docs.select(column(docs, "doc_id").alias("doc_id"), column(docs, "source", "string").alias("source"), word_count(column(docs, "text", "string")).alias("size"))
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = broadcast_if_small(store(source_targets(totals, weights, share, most)).withColumnRenamed("source", "of"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return sized.join(targets, F.col("source").eqNullSafe(F.col("of"))).select("doc_id", "source", "size", "source_size", "target", copies_of(rate, ["doc_id"], seed).alias("copies"))


def mix_sources(docs: DataFrame, *, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 42) -> DataFrame:
    """The documents of the mix, each row as often as it is taken, with all of its columns. See ``plan_mix``."""
    size, of, rate = fresh(docs, "mix_size"), fresh(docs, "mix_source"), fresh(docs, "mix_rate")
    sized = docs.select(column(docs, "source", "string").alias("source"), word_count(column(docs, "text", "string")).alias("source_size"))
    totals = sized.groupBy("source").agg(F.sum("source_size").alias("source_size"))
    targets = source_targets(totals, weights, share, most)
    rates = store(targets.select(F.col("source").alias(of), F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias(rate)))
    joined = docs.join(broadcast_if_small(rates), column(docs, "source", "string").eqNullSafe(F.col(of)))
    repeated = joined.withColumn(size, F.explode(F.array_repeat(F.lit(0), copies_of(F.col(rate), ["doc_id"], seed).cast("int"))))
    return repeated.select(*docs.columns)
