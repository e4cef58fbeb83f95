"""The registered queries of these operators, each over its whole table, beside their SQL where SQL can express them."""

from __future__ import annotations

import json
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from quillframe.llm.alignment import align_tokenizers
from quillframe.llm.bpe import encode_documents
from quillframe.llm.co_training import quality_scores
from quillframe.llm.collocations import mine_collocations
from quillframe.llm.language import identify, train
from quillframe.llm.mixing import plan_mix
from quillframe.llm.multi_index import nearest_neighbours
from quillframe.llm.packing import pack_documents
from quillframe.llm.pseudo_likelihood import pseudo_likelihood
from quillframe.llm.secrets import find_secrets
from quillframe.llm.sharding import shard_by_bytes
from quillframe.llm.simhash import simhash_components
from quillframe.llm.sketch import fingerprint_versions

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Query, str | None]] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        REGISTRY[run.__name__] = (run, sql)
        return run

    return register


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def ranks() -> bytes:
    return _content("byte_bpe_50k.tiktoken")


def added_tokens() -> dict[str, int]:
    return {token["content"]: token["id"] for token in json.loads(_content("byte_bpe_50k.json"))["added_tokens"]}


def _content(name: str) -> bytes:
    with open(public_tokenizers.path(name), "rb") as file:
        return file.read()


@query()
def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(documents(spark, folder), ranks(), public_tokenizers.PATTERN, added=added_tokens())


# CRC-32 step by step: the table follows from its polynomial, the bytes from the code points.
@query("""
WITH chars AS (
  SELECT doc_id, coalesce(text, '') AS t, list_transform(string_split(coalesce(text, ''), ''), lambda c: unicode(c)::BIGINT) AS u FROM documents
), encoded AS (
  SELECT doc_id, CASE WHEN t = '' THEN []::BIGINT[] ELSE flatten(list_transform(u, lambda c: CASE WHEN c < 128 THEN [c]
    WHEN c < 2048 THEN [192 + (c >> 6), 128 + (c & 63)] WHEN c < 65536 THEN [224 + (c >> 12), 128 + ((c >> 6) & 63), 128 + (c & 63)]
    ELSE [240 + (c >> 18), 128 + ((c >> 12) & 63), 128 + ((c >> 6) & 63), 128 + (c & 63)] END)) END AS b FROM chars
), steps AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY i) AS k
  FROM (SELECT unnest(range(256)) AS i)
), sized AS (
  SELECT doc_id, (len(b) + 8)::BIGINT AS size,
    xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(list_extract(k, (xor(c, x) & 255) + 1), c >> 8)), 4294967295)::BIGINT AS text_crc32 FROM encoded, steps
), placed AS (
  SELECT *, ((2 * sum(size) OVER (ORDER BY doc_id) - size) * 24 // (2 * sum(size) OVER ()))::INT AS shard FROM sized
)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, (row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1)::BIGINT AS slot, NULL::INT AS grown_shard FROM placed
""")
def op2_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return shard_by_bytes(documents(spark, folder))


@query()
def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_components(documents(spark, folder))


@query("""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents
), totals AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), ranked AS (
  SELECT source, source_size, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY (source IS NULL), source) - 1) % 3 + 1)::INT]::DOUBLE AS weight FROM totals
), limited AS (
  SELECT *, source_size * 2.0::DOUBLE AS top, source_size * 2.0::DOUBLE / weight AS full_at FROM ranked
), levels AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
      - coalesce(sum(top) OVER (ORDER BY full_at, (source IS NULL), source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
    / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY full_at, (source IS NULL), source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0)) AS level
  FROM limited
), targets AS (
  SELECT source, source_size, least(top, coalesce(max(CASE WHEN level <= full_at THEN level END) OVER () * weight, top)) AS target FROM levels
), rates AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  (size * (floor(rate)::BIGINT + CASE WHEN ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':42'), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM rates
""")
def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    planned = plan_mix(documents(spark, folder))
    return planned.selectExpr("doc_id", "size", "source_size", "target", "size * copies AS taken")


@query()
def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    model = train(docs.where(~held_out).select("doc_id", "text", "lang"))
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


@query()
def op5_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    return find_secrets(documents(spark, folder))


@query()
def op8_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return nearest_neighbours(spark.read.parquet(f"{folder}/embeddings.parquet"))


@query()
def op9_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint_versions(documents(spark, folder))


@query()
def op6_pseudo_likelihood(spark: SparkSession, folder: str) -> DataFrame:
    return pseudo_likelihood(documents(spark, folder))


@query()
def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality_scores(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))


@query("""
WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), cut AS (
  SELECT lang, list_transform(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]'), lambda x: regexp_extract_all(x, '[^\x20\x09]+')) AS lists FROM docs
), pieces AS (
  SELECT lang, unnest(lists) AS w FROM cut
), totals AS (
  SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang
), grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM pieces, (VALUES (1), (2), (3), (4)) AS sizes(k) WHERE len(w) >= k
), f AS (
  SELECT lang, k, phrase, string_split(phrase, ' ') AS w, count(*) AS a FROM grams GROUP BY lang, k, phrase HAVING count(*) >= 30
), cuts AS (
  SELECT c.lang, c.phrase, c.a, cut_at, x.a AS l, y.a AS r, ((2000000::HUGEINT * c.a) // (x.a + y.a))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut_at FROM f WHERE k > 1) c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:cut_at], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[cut_at + 1:c.k], ' ')
), lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut_at) = 1
), inside AS (
  SELECT lang, a, unnest(flatten(list_transform(range(2, k), lambda s: list_transform(range(1, k - s + 2), lambda i: array_to_string(w[i:i + s - 1], ' '))))) AS phrase
  FROM f WHERE k > 2
), longer AS (
  SELECT lang, phrase, max(a) AS most FROM inside GROUP BY lang, phrase
), kept AS (
  SELECT c.* FROM lowest c LEFT JOIN longer m ON m.lang = c.lang AND m.phrase = c.phrase WHERE m.most IS NULL OR 100::HUGEINT * m.most < 80::HUGEINT * c.a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000
""")
def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return mine_collocations(documents(spark, folder))


@query()
def op12_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return encode_documents(documents(spark, folder), _content("byte_bpe_50k.json").decode(), with_ids=False)


@query()
def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return align_tokenizers(documents(spark, folder), ranks(), public_tokenizers.PATTERN, _content("piece_bpe_32k.model"))
