"""A corpus made ready for training: language ID, near-duplicates, secrets, mixing and packing, one stage after the other.

Every stage reads what the one before it has written. All but the last return the columns of ``documents``:

1. ``language``: rows whose language is rejected go: texts without a letter, and texts unlike any learned language;
2. ``near_duplicates``: of each group of texts with linked fingerprints one row stays;
3. ``secrets``: secrets are masked in the texts, also those in encoded layers, and ``n_chars`` is counted anew;
4. ``mix``: rows are repeated or left out so that the sources meet their target weights;
5. ``pack``: documents become pieces of sequences of 1,024 tokens, with their ids.

NULLs in any column, empty and very long texts, repeated rows, empty tables and further columns are handled as the operators
say. A table without any row goes through all stages and comes out empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quillframe.functions.sizing import store
from quillframe.llm.language import keep_identified
from quillframe.llm.mixing import mix_sources
from quillframe.llm.packing import pack_documents
from quillframe.llm.queries import REGISTRY, added_tokens, documents, ranks
from quillframe.llm.secrets import redact_secrets
from quillframe.llm.simhash import keep_one_of_each


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_of_each(docs, words=3, max_bits=3)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact_secrets(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_sources(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, ranks(), public_tokenizers.PATTERN, added=added_tokens(), with_ids=True)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("secrets", secrets), ("mix", mix), ("pack", pack)]
ORACLE_SQL = None  # language models, fingerprints, decoding and packing are not expressible; the stages are tested by brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages on ``documents``, each stage written and read again."""
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {**REGISTRY, "pipeline": (run, ORACLE_SQL)}
