from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from quillframe.llm.mixing import plan_mix
from quillframe.llm.queries import documents
from quillframe.llm.secrets import all_spans, redact
from test_simhash import plain_components, plain_fingerprint

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def written(spark, folder, tmp_path_factory):
    """What each stage got and what it wrote."""
    docs, result = documents(spark, folder), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "out")
        stage(spark, docs, folder).write.parquet(path)
        again = spark.read.parquet(path)
        result.append((name, docs.collect(), again.collect(), again.columns))
        docs = again
    return {name: rest for name, *rest in result}


def test_language_stage_keeps_clean_documents(written):
    before, after, columns = written["language"]
    assert columns == COLUMNS and set(after) <= set(before)
    gone = Counter(before) - Counter(after)
    assert sum(gone.values()) <= 0.01 * len(before) or all(not any(map(str.isalpha, r.text or "")) for r in gone)


def test_one_document_of_each_group_stays(written):
    before, after, columns = written["near_duplicates"]
    assert columns == COLUMNS
    groups = defaultdict(list)
    for row, component in zip(before, plain_components([(r.doc_id, plain_fingerprint(r.text)) for r in before])):
        groups[component].append(row)
    assert Counter(after) == Counter(next(r for r in rows if r.doc_id == component) for component, rows in groups.items())
    assert len(after) < len(before)


def test_secrets_are_masked(written):
    before, after, columns = written["secrets"]
    assert columns == COLUMNS
    expected = Counter()
    for r in before:
        text = redact(r.text, all_spans(r.text)[1])
        expected[(r.doc_id, text, r.lang, r.source, r.n_chars if text == r.text else len(text))] += 1
    assert Counter(map(tuple, after)) == expected


def test_mix_and_packing(spark, written):
    before, after, columns = written["mix"]
    assert columns == COLUMNS
    copies = {r.doc_id: r.copies for r in plan_mix(spark.createDataFrame(before)).collect()}
    assert Counter(r.doc_id for r in after) == Counter({k: v for k, v in copies.items() if v})
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs, pieces, columns = written["pack"]
    assert {"doc_id", "ids", "sequence_id", "offset"} <= set(columns)
    expected = Counter()
    for r in docs:
        ids = [*tokenizer.encode(r.text, add_special_tokens=False).ids, 0]
        expected.update((r.doc_id, at, zlib.crc32(np.array(ids[at : at + 1024], "<u4").tobytes())) for at in range(0, len(ids), 1024))
    assert Counter((p.doc_id, p.start, zlib.crc32(np.array(p.ids, "<u4").tobytes())) for p in pieces) == expected


def test_odd_and_empty_tables(spark, odd, none):
    for table in (odd, none):
        docs = table
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, "")
            if name != "pack":
                assert docs.columns == table.columns
            docs = docs.checkpoint() if spark.sparkContext.getCheckpointDir() else docs
        assert (docs.count() == 0) == (table.count() == 0)


def test_run_and_registration(spark, folder):
    import __spark_entry__ as entry

    assert corpus_pipeline.run(spark, folder).count() > 0
    numbered = [name for name in entry.queries() if name.startswith("op")]
    assert sorted(int(name[2:].split("_")[0]) for name in numbered) == list(range(1, 14)) and "pipeline" in entry.queries()
