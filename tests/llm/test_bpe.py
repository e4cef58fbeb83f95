from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quillframe.errors import TableError
from quillframe.llm.bpe import Encoder, Vocabulary, encode_documents, merge_words
from quillframe.llm.queries import REGISTRY

CONTENT = open(public_tokenizers.path("byte_bpe_50k.json")).read()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary(CONTENT)


def row(library, doc_id, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    decoded = library.decode(ids, skip_special_tokens=False)
    return (doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())


def test_ids_and_texts_are_those_of_the_library(library, vocabulary):
    draw = random.Random(7)
    ranges = [(32, 127), (0, 33), (0x80, 0x3000), (0x4E00, 0x9FFF), (0xE000, 0x110000)]
    made = ["".join(chr(draw.randrange(*draw.choice(ranges))) for _ in range(draw.randrange(120))) for _ in range(400)]
    made += ["", " ", "\n\n a", "aaaaaaaaa", "a" * 30_000, " " * 3_000, "<|endoftext|>", "hello <|endoftext|> world", "<|endoftext|><|endoftext|>x", "<|endof", "it's we'LL 12 345"]
    encoder = Encoder(vocabulary)
    ids = [i for at in range(0, len(made), 50) for i in encoder.encode(made[at : at + 50])]
    assert ids == [library.encode(text, add_special_tokens=False).ids for text in made]
    assert [vocabulary.decode(np.array(i, np.int64)) for i in ids] == [library.decode(i, skip_special_tokens=False) for i in ids]
    assert vocabulary.decode(np.array([158, 227], np.int64)) == library.decode([158, 227], skip_special_tokens=False)  # broken bytes


def test_letters_that_the_library_does_not_know_yet(library, vocabulary):
    texts = [f"a{chr(c)}a 1{chr(c)}1 ,{chr(c)}," for c in range(0x80, 0x3000)]
    assert Encoder(vocabulary).encode(texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_merging_words_together_equals_merging_each_alone(vocabulary):
    draw = random.Random(1)
    words = ["".join(draw.choice("abcthe ,") for _ in range(draw.randrange(1, 30))) for _ in range(500)] + ["\0", "a\0b", "aa", "aaa", "aaaa"]
    assert merge_words(words, vocabulary) == [merge_words([word], vocabulary)[0] for word in words]
    assert merge_words([], vocabulary) == []


def test_known_words_do_not_change_results(library, vocabulary, monkeypatch):
    monkeypatch.setattr("quillframe.llm.bpe._KEPT_WORDS", 3)
    encoder, texts = Encoder(vocabulary), ["one two three four", "two five <|endoftext|>", "one six"]
    assert [encoder.encode([t])[0] for t in texts * 2] == [library.encode(t, add_special_tokens=False).ids for t in texts * 2]


def test_odd_rows(spark, odd, library):
    result = encode_documents(odd, CONTENT)
    rows = result.collect()
    expected = [row(library, r["doc_id"], r["text"]) for r in odd.collect()]
    assert sorted(map(repr, (tuple(r)[:4] for r in rows))) == sorted(map(repr, expected))
    assert all(len(r["ids"]) == r["n_tokens"] for r in rows)
    assert encode_documents(odd.limit(0), CONTENT).collect() == []


def test_other_vocabularies_are_refused():
    with pytest.raises(TableError):
        Vocabulary(open(public_tokenizers.path("word_bpe_49k.json")).read())


def test_query(spark, folder, library):
    documents = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    rows = REGISTRY["op12_bpe"][0](spark, folder).collect()
    assert sorted(map(tuple, rows)) == sorted(row(library, r["doc_id"], r["text"]) for r in documents)
