from __future__ import annotations

import math
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow as pa
import pytest

from quillframe.llm import pseudo_likelihood as pl
from quillframe.llm.co_training import platt, quality_scores
from quillframe.llm.queries import REGISTRY, documents


@pytest.fixture(scope="module")
def table():
    return "/root/testdata/sf0.01"


def test_quality_of_held_out_documents(spark, table):
    docs, labels = documents(spark, table), spark.read.parquet(f"{table}/labels.parquet")
    learnt, held = labels.where("doc_id % 4 <> 0"), {r.doc_id: r.quality for r in labels.where("doc_id % 4 = 0").collect()}
    found = {r.doc_id: r for r in quality_scores(docs, learnt).collect()}
    assert len(found) == docs.count() and all(0 <= r.score <= 1 and r.keep == (r.score >= 0.5) for r in found.values())
    right = np.mean([found[i].keep == (q == 1) for i, q in held.items()])
    clean = np.mean([found[i].keep for i, q in held.items() if q == 1])
    assert right > 0.95 and clean > 0.97, (right, clean)


def test_quality_query_covers_all(spark, folder):
    found = REGISTRY["op7_quality"][0](spark, folder)
    assert Counter(r.doc_id for r in found.collect()) == Counter(r.doc_id for r in documents(spark, folder).collect())


def test_quality_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (4, 0), (7, 1), (8, 1), (8, 1), (9, 1), (9, 0), (None, 1), (10, None), (11, 7)], "doc_id long, quality int")
    assert quality_scores(odd, labels).count() == odd.count()
    assert quality_scores(none, labels).count() == 0
    assert {r.score for r in quality_scores(odd, labels.where("quality = 1")).collect()} == {1.0}
    assert {r.score for r in quality_scores(odd, labels.limit(0)).collect()} == {0.5}


def test_calibration():
    draw = np.random.default_rng(1)
    odds = draw.normal(0, 2, 20_000)
    labels = (draw.random(20_000) < 1 / (1 + np.exp(-(0.5 * odds + 1)))).astype(float)
    assert np.allclose(platt(odds, labels), (0.5, 1), atol=0.08)


def test_gradients_against_differences():
    p = {k: v.astype(np.float64) for k, v in pl.initial(3).items()}
    draw = np.random.default_rng(2)
    around, tokens = draw.integers(0, pl.TOKENS, (40, 4)), draw.integers(0, pl.TOKENS, 40)
    found = pl.gradients(p, around, tokens)
    loss = lambda: -pl.log_probabilities(p, around, tokens).mean()
    for name in pl.SHAPES:
        place = tuple(draw.integers(0, s) for s in p[name].shape) if name != "embed" else (around[3, 1], 5)
        if name == "inside":
            place = (tokens[0] % pl.CLASSES, 4, tokens[0] // pl.CLASSES)
        slope = found[name][place] if name != "embed" else found["embed"].reshape(40, 4, -1)[around == around[3, 1]].sum(0)[5]
        p[name][place] += 1e-5
        up = loss()
        p[name][place] -= 2e-5
        down = loss()
        p[name][place] += 1e-5
        assert math.isclose((up - down) / 2e-5, slope, rel_tol=1e-3, abs_tol=1e-7), name


def test_probabilities_sum_to_one():
    p = pl.initial(5)
    around = np.tile(np.array([[3, 900, pl.TOKENS, 17]]), (pl.TOKENS, 1))
    assert math.isclose(np.exp(pl.log_probabilities(p, around, np.arange(pl.TOKENS))).sum(), 1, rel_tol=1e-4)


def test_real_order_scores_above_shuffled(spark, table):
    docs = documents(spark, table)
    vocabulary, p = pl.train(docs)
    rows = docs.where("n_chars > 1500").limit(60).collect()
    draw = np.random.default_rng(1)
    shuffled = [(r.doc_id, " ".join(draw.permutation(r.text.split()).tolist())) for r in rows]
    real = {r.doc_id: r for r in pl.score(spark.createDataFrame([(r.doc_id, r.text) for r in rows], "doc_id long, text string"), vocabulary, p).collect()}
    mixed = {r.doc_id: r for r in pl.score(spark.createDataFrame(shuffled, "doc_id long, text string"), vocabulary, p).collect()}
    counts = Counter(t for r in docs.collect() for t in pl.encode(r.text, vocabulary).tolist())
    total = sum(counts.values())
    alone = {r.doc_id: sum(math.log(counts[t] / total) for t in pl.encode(r.text, vocabulary).tolist()) for r in rows}
    assert sum(r.log_likelihood for r in real.values()) > sum(alone.values())  # better than the counts of single tokens
    assert sum(r.log_likelihood for r in real.values()) >= sum(r.log_likelihood for r in mixed.values())


def test_scores_against_a_plain_loop(spark, odd, none):
    vocabulary, p = pl.train(odd, rounds=2)
    found = sorted(map(str, pl.score(odd, vocabulary, p).select("doc_id", "n_tokens").collect()))
    assert found == sorted(f"Row(doc_id={r.doc_id}, n_tokens={len((r.text or '').split())})" for r in odd.collect())
    for r in pl.score(odd, vocabulary, p).collect():
        assert (r.score is None) == (r.n_tokens == 0) and r.log_likelihood <= 0
    text = "one two three four five"
    tokens = pl.encode(text, vocabulary)
    padded = [pl.TOKENS, pl.TOKENS, *tokens, pl.TOKENS, pl.TOKENS]
    plain = 0.0
    for i in range(2, 7):
        hidden = np.tanh(np.concatenate([p["embed"][padded[j]] for j in (i - 2, i - 1, i + 1, i + 2)]) @ p["mix"] + p["mix_bias"])
        a = hidden @ p["of_class"] + p["class_bias"]
        b = hidden @ p["inside"][padded[i] % pl.CLASSES] + p["inside_bias"][padded[i] % pl.CLASSES]
        plain += a[padded[i] % pl.CLASSES] - np.log(np.exp(a).sum()) + b[padded[i] // pl.CLASSES] - np.log(np.exp(b).sum())
    got = pl.score(spark.createDataFrame([(1, text)], "doc_id long, text string"), vocabulary, p).first()
    assert math.isclose(got.log_likelihood, plain, rel_tol=1e-4)
    assert pl.pseudo_likelihood(none).count() == 0


def test_every_position_is_trained_on():
    class Held:
        def __init__(self, value):
            self.value = value

    texts = ["one two three four five six seven", "", "a", " ".join(map(str, range(1001)))]
    batch = pa.RecordBatch.from_pydict({"text": texts, "draw": pa.array([5, 6, 7, 8], pa.int64()), "part": pa.array([0] * 4, pa.int32())})
    done = list(pl._descend(Held({"one": 0, "a": 1}), Held(pl.packed(pl.initial(1))), 0.1)(iter([batch])))
    assert [row["seen"] for found in done for row in found.to_pylist()] == [7 + 1 + 1001]


def test_places_of_all_classes_are_weighed_at_once(monkeypatch):
    """A softmax for the classes and one for the places in them, not one more for each class."""
    p, draw = pl.initial(4), np.random.default_rng(4)
    around, tokens = draw.integers(0, pl.TOKENS + 1, (500, 4)), draw.integers(0, pl.TOKENS, 500)
    calls, plain = [], pl._softmax
    monkeypatch.setattr(pl, "_softmax", lambda logits: calls.append(logits.shape) or plain(logits))
    pl.gradients(p, around, tokens)
    assert calls == [(500, pl.CLASSES), (500, pl.TOKENS // pl.CLASSES)]


def test_words_are_those_of_python():
    every = [f"{chr(i)}a{chr(i)}{chr(i)}B{chr(i)}" for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    found, sizes = pl.words(["", "  ", *every, "ΟΔΟΣ ΟΔΟΣ\x1cx", "one"])
    plain = [text.lower().split() for text in ["", "  ", *every, "ΟΔΟΣ ΟΔΟΣ\x1cx", "one"]]
    assert sizes.tolist() == [len(part) for part in plain]
    assert found.to_pylist() == [word for part in plain for word in part]


def test_tokens_of_all_texts_at_once():
    vocabulary = {"the": 0, "été": 2, "x": 1}
    texts = ["The x ÉTÉ of", "", "unseen \U0001f600\U0001f601\U0001f602\U0001f603 ab é", "\t"]
    for known in (vocabulary, {}):
        plain = [[known.get(word, pl.FREQUENT + zlib.crc32(word[-3:].encode()) % pl.RARE) for word in text.lower().split()] for text in texts]
        tokens, sizes = pl.encode_all(texts, known)
        assert tokens.tolist() == [t for part in plain for t in part] and sizes.tolist() == [4, 0, 4, 0]
        assert [pl.encode(text, known).tolist() for text in texts] == plain


def test_counts_of_words(spark, odd):
    plain = Counter(word for r in odd.collect() for word in (r.text or "").lower().split())
    texts = odd.selectExpr("coalesce(text, '') AS text")
    assert {r.word: r.n for r in pl.count_words(texts).collect()} == plain


def test_steps_use_their_arrays_again():
    """After the first batch, less is taken anew than three arrays of a batch by the hidden layer."""
    draw = np.random.default_rng(6)
    around, tokens = draw.integers(0, pl.TOKENS + 1, (pl.BATCH, 4)), np.sort(draw.integers(0, pl.TOKENS, pl.BATCH) % pl.CLASSES)
    trainer = pl.Trainer(pl.initial(6), 0.1)
    trainer.step(around, tokens)
    tracemalloc.start()
    trainer.step(around, tokens)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 3 * pl.BATCH * pl.HIDDEN * 4


def test_blocks_that_are_scored_hold_few_classes(monkeypatch):
    draw, weighed, plain = np.random.default_rng(7), [], pl._inside
    p, sizes = pl.initial(7), np.array([3000, 0, 1, 9000])
    row, at, _ = pl._padded(tokens := draw.integers(0, pl.TOKENS, sizes.sum()), sizes)
    whole = pl.log_probabilities(p, pl._around(row, at), tokens)
    monkeypatch.setattr(pl, "_inside", lambda p, hidden, classes, *rest: weighed.append(len(classes)) or plain(p, hidden, classes, *rest))
    assert np.allclose(pl._in_blocks(p, row, at, pl._Room()), whole, rtol=1e-5)
    assert sum(weighed) < len(tokens) / pl.BLOCK + 1 + pl.CLASSES
