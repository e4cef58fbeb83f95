from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quillframe.llm.mixing import mix_sources, plan_mix
from quillframe.llm.packing import first_fit_decreasing, pack_documents
from quillframe.llm.queries import REGISTRY, added_tokens, documents, ranks
from quillframe.llm.sharding import shard_by_bytes


def pieces(df):
    return [row.asDict() for row in df.collect()]


def check_packing(docs, found, tokenizer, length):
    ids = {}
    for doc_id, text in docs:
        ids.setdefault(doc_id, []).append([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0])
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for p in found:
        by_sequence[p["sequence_id"]].append((p["offset"], p["length"]))
        by_doc[p["doc_id"]].append(p)
    for parts in by_sequence.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= length
    assert set(by_doc) == set(ids)
    for doc_id, texts in ids.items():
        expected = Counter(
            (at, min(length, len(one) - at), zlib.crc32(np.array(one[at : at + length], "<u4").tobytes()), len(one)) for one in texts for at in range(0, len(one), length)
        )
        assert Counter((p["start"], p["length"], p["ids_crc32"], p["doc_tokens"]) for p in by_doc[doc_id]) == expected
    return by_sequence


def test_packing_of_a_table(spark, folder):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = [(r.doc_id, r.text) for r in documents(spark, folder).collect()]
    found = pieces(REGISTRY["op1_packing"][0](spark, folder))
    sequences = check_packing(docs, found, tokenizer, 1024)
    tokens = sum(p["length"] for p in found)
    assert len(sequences) * 1024 < tokens * 1.02 + 1024


def test_packing_of_odd_rows(spark, odd, none):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = pack_documents(odd, ranks(), public_tokenizers.PATTERN, added=added_tokens(), length=64, docs_per_group=3, with_ids=True)
    rows = pieces(found)
    check_packing([(r.doc_id, r.text) for r in odd.collect()], rows, tokenizer, 64)
    for row in rows:
        assert zlib.crc32(np.array(row["ids"], "<u4").tobytes()) == row["ids_crc32"]
    assert pack_documents(none, ranks(), public_tokenizers.PATTERN).count() == 0


def test_first_fit_decreasing_against_a_plain_search():
    sizes = np.random.default_rng(1).integers(1, 101, 300)
    room, plain = [], {}
    for i in np.argsort(-sizes, kind="stable").tolist():
        at = next((b for b, free in enumerate(room) if free >= sizes[i]), None)
        if at is None:
            room.append(100)
            at = len(room) - 1
        room[at] -= sizes[i]
        plain[i] = at
    assert first_fit_decreasing(sizes, 100).tolist() == [plain[i] for i in range(300)]
    assert first_fit_decreasing(sizes[:0], 100).tolist() == []


def check_shards(found, docs, shards):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == Counter((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in docs)
    total, largest = sum(r.size for r in found), max(r.size for r in found)
    by_shard = defaultdict(list)
    for r in found:
        by_shard[r.shard].append(r)
        assert 0 <= r.shard < shards and r.law == "bytes" and r.grown_shard is None
    for rows in by_shard.values():
        assert sorted(r.slot for r in rows) == list(range(len(rows)))
        assert abs(sum(r.size for r in rows) - total / shards) <= largest
    ordered = sorted(found, key=lambda r: (r.shard, r.slot))
    ids = [-1 if r.doc_id is None else r.doc_id for r in ordered]
    assert ids == sorted(ids)


def test_shards_of_a_table(spark, folder):
    docs = [(r.doc_id, r.text) for r in documents(spark, folder).collect()]
    check_shards(REGISTRY["op2_sharding"][0](spark, folder).collect(), docs, 24)


def test_shards_of_odd_rows(spark, odd, none):
    check_shards(shard_by_bytes(odd, 3).collect(), [(r.doc_id, r.text) for r in odd.collect()], 3)
    assert shard_by_bytes(none).count() == 0


def targets_by_hand(sizes, weights, share, most):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, capped, left = {}, set(), share * sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in capped]
        total = sum(weight[s] for s in open_)
        target |= {s: left * weight[s] / total for s in open_}
        over = [s for s in open_ if target[s] > most * sizes[s]]
        if not over:
            return target
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
            capped.add(s)
        if len(capped) == len(names):
            return target


def check_mix(rows, docs):
    sizes = Counter()
    for _, text, source in docs:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    expected = targets_by_hand(sizes, (5, 2, 1), 1.5, 2.0)
    taken = Counter()
    for r in rows:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, expected[r.source], rel_tol=1e-9, abs_tol=1e-9)
        assert r.copies <= 2
        taken[r.source] += r.size * r.copies
    return taken, expected


def test_mix_of_a_table(spark, folder):
    docs = [(r.doc_id, r.text, r.source) for r in documents(spark, folder).collect()]
    planned = plan_mix(documents(spark, folder))
    taken, expected = check_mix(planned.collect(), docs)
    assert abs(sum(taken.values()) / sum(expected.values()) - 1) < 0.2
    copies = {r.doc_id: r.copies for r in planned.collect()}
    mixed = mix_sources(documents(spark, folder))
    assert mixed.columns == documents(spark, folder).columns
    assert Counter(r.doc_id for r in mixed.collect()) == Counter({k: v for k, v in copies.items() if v})


def test_mix_of_odd_rows(spark, odd, none):
    check_mix(plan_mix(odd).collect(), [(r.doc_id, r.text, r.source) for r in odd.collect()])
    assert mix_sources(odd).columns == odd.columns
    assert plan_mix(none).count() == 0 and mix_sources(none).count() == 0


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", ["op2_sharding", "op10_mixing"])
def test_query_agrees_with_sql(spark, scale, name):
    folder = f"/root/testdata/{scale}"
    run, sql = REGISTRY[name]
    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    expected = db.sql(sql)
    found = run(spark, folder)
    assert sorted(tuple(r) for r in found.collect()) == sorted(expected.fetchall())
    assert found.columns == expected.columns
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}
    assert [kinds[kind] for _, kind in found.dtypes] == [str(t) for t in expected.types]
