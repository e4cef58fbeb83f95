from __future__ import annotations

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from quillframe.llm import collocations
from quillframe.llm.collocations import frequent_phrases, mine_collocations
from quillframe.llm.queries import REGISTRY


def brute(rows, min_count=30, covered=80, top=2000):
    totals, counts = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", folded):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, 5):
                counts.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    frequent = {key: n for key, n in counts.items() if n >= min_count}
    longest = Counter()
    for (lang, phrase), n in frequent.items():
        for inner in {phrase[i:j] for i in range(len(phrase)) for j in range(i + 2, len(phrase) + 1)} - {phrase}:
            longest[lang, inner] = max(longest[lang, inner], n)
    result = []
    for lang in totals:
        kept = []
        for (l_, phrase), a in frequent.items():
            if l_ != lang or len(phrase) == 1:
                continue
            cuts = [(2000000 * a // (counts[lang, phrase[:k]] + counts[lang, phrase[k:]]), k) for k in range(1, len(phrase))]
            score, k = min(cuts)
            if 100 * longest[lang, phrase] < covered * a or (lang, phrase) not in longest:
                kept.append((-score, -a, " ".join(phrase).encode(), counts[lang, phrase[:k]], counts[lang, phrase[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(kept)[:top], 1):
            result.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(result)


def found(df, **options):
    return sorted(tuple(row) for row in mine_collocations(df, **options).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def texts(seed, n=300):
    draw = random.Random(seed)
    words = [*"abcdefgh", "New", "york", "CITY", "é", "ÀB", "x y", "\x00"]
    gaps = [" ", "  ", "\t", ", ", ". ", "\n", "\x0b", "; ", " ? ", "\r\n"]
    rows = []
    for i in range(n):
        parts = [draw.choice(["new york city", draw.choice(words), draw.choice(words)]) + draw.choice(gaps[:3] * 6 + gaps) for _ in range(draw.randrange(60))]
        rows.append((draw.choice(["en", "en", "en", "fr", None, "und"]), "".join(parts)))
    return rows


@pytest.mark.parametrize(("shard_words", "min_count", "top"), [(150, 30, 2000), (1500, 7, 20)])
def test_equals_brute_force_at_every_size_of_shards(spark, shard_words, min_count, top):
    rows = texts(shard_words)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    assert found(df, shard_words=shard_words, min_count=min_count, top=top) == brute(rows, min_count, top=top)


def test_every_phrase_is_counted_exactly_even_if_the_table_of_bits_is_full(spark, monkeypatch):
    monkeypatch.setattr(collocations, "_TABLE_BITS", 16)
    monkeypatch.setattr(collocations, "_union", lambda *_: np.full(1 << 13, 255, np.uint8))
    rows = texts(3, 100)
    phrases, totals = frequent_phrases(spark.createDataFrame(rows, "lang string, text string"), min_count=1)
    counts = Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m.group().lower(), text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, 5):
                counts.update((lang or "und", " ".join(words[i : i + k])) for i in range(len(words) - k + 1))
    assert {(r["lang"], r["phrase"]): r["n"] for r in phrases.collect()} == counts


def test_overlaps_ties_and_covered_phrases(spark):
    rows = [("en", "a a a a"), ("en", "b c d. b c d. b c. b d. c b")] * 40
    df = spark.createDataFrame(rows, "lang string, text string")
    assert found(df) == brute(rows)
    assert ("en", "a a") not in {row[:1] + row[2:3] for row in found(df) if row[3] == 80}  # three times in each text
    assert not any(row[2] == "c d" for row in found(df))  # each of them is in a longer one


def test_odd_rows(spark, odd):
    rows = [(r["lang"], r["text"]) for r in odd.collect()]
    assert found(odd, min_count=2) == brute(rows, 2)
    assert found(odd.limit(0)) == []


def test_query_agrees_with_sql(spark, folder):
    run, sql = REGISTRY["op11_collocations"]
    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    expected = db.sql(sql)
    rows = sorted(tuple(row) for row in run(spark, folder).select(*expected.columns).collect())
    assert rows and rows == sorted(expected.fetchall())


def test_a_task_adds_up_the_counts_of_its_shards(spark):
    """Rows handed on by mining must grow with tasks, not with shards times buckets."""
    docs = spark.createDataFrame([(i, "a b c d e f g h " * 20, "en") for i in range(200)], "doc_id long, text string, lang string").coalesce(1)
    shards = collocations._shards(docs, 160).cache()
    totals = spark.sparkContext.broadcast({"en": (32_000, 1000)})
    mined = collocations._mine(shards, 1, None, totals, 30, 8).collect()
    found = {h: n for r in mined for h, n in zip(np.frombuffer(r["hashes"], np.uint64).tolist(), np.frombuffer(r["counts"], np.uint32).tolist())}
    assert shards.count() == 200 and len(mined) <= 8 and sorted(found.values()) == [4000] * 8
    shards.unpersist()


def test_tasks_hand_on_packed_counts(spark):
    """Two fifths of the bytes that hashes and counts of full width took, with nothing lost."""
    docs = spark.createDataFrame([(f"w{i * 7919 % 10007} v{i * 104729 % 9973} " * 3, "en") for i in range(20_000)], "text string, lang string").coalesce(1)
    shards = collocations._shards(docs, 1 << 18).cache()
    totals = spark.sparkContext.broadcast({"en": (12_000_000, 29)})
    plain, short = (collocations._mine(shards, 1, None, totals, 30, 8, *more).collect() for more in ((), (True,)))
    bytes_of = lambda rows: sum(len(row["hashes"]) + len(row["counts"]) for row in rows)
    assert bytes_of(short) < 0.4 * bytes_of(plain)
    slots = {(r["bucket"], int(s)): n for r in short for s, n in zip(np.cumsum(collocations._unpacked(r["hashes"], np.uint32)), collocations._unpacked(r["counts"], np.uint32).tolist())}
    expected = {}
    for r in plain:
        for h, n in zip(np.frombuffer(r["hashes"], np.uint64).tolist(), np.frombuffer(r["counts"], np.uint32).tolist()):
            expected[r["bucket"], h >> 32 & 0xFFFFFF] = min(n, 30)
    assert slots == expected and len(slots) > 19_000
    shards.unpersist()
