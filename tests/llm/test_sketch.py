from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest

from quillframe.llm.queries import REGISTRY, documents
from quillframe.llm.sketch import Tables, _flat, differences, digests, edited, fingerprint_versions


def plain(docs):
    """What each document should have, from the texts in order."""
    result = []
    for i, (doc_id, text) in enumerate(docs):
        following = docs[(i + 1) % len(docs)][1]
        version = text[: len(text) - len(text) // 2] + following[: len(text) // 2]
        likeness = []
        for other in (version, following):
            a, b = set(digests(text).tolist()), set(digests(other).tolist())
            likeness.append(1 - len(a ^ b) / (len(a) + len(b)) if a or b else 1.0)
        result.append((doc_id, len(text), hashlib.sha256(version.encode()).hexdigest(), *likeness))
    return result


def check(found, expected):
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in found) == Counter((*e[:3], round(e[3], 9), round(e[4], 9)) for e in expected)


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_a_table(spark, scale):
    folder = f"/root/testdata/{scale}"
    docs = sorted((r.doc_id, r.text or "") for r in documents(spark, folder).collect())
    found = REGISTRY["op9_fingerprints"][0](spark, folder).collect()
    check(found, plain(docs))
    texts = dict(docs)
    by_text, by_mark = {}, {}
    for r in found:
        assert by_text.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint
        assert by_mark.setdefault(r.fingerprint, set(digests(texts[r.doc_id]).tolist())) == set(digests(texts[r.doc_id]).tolist())


def test_peeling_recovers_any_difference():
    draw = np.random.default_rng(4)
    pool = draw.integers(0, 1 << 63, 5000, dtype=np.uint64)
    left = [draw.choice(pool, n, replace=False) for n in (0, 1, 5, 40, 900, 3000)]
    right = [draw.choice(pool, n, replace=False) for n in (0, 0, 5, 60, 10, 3000)]
    assert differences(left, right).tolist() == [len(set(a.tolist()) ^ set(b.tolist())) for a, b in zip(left, right)]
    assert differences(left, left).tolist() == [0] * 6


def test_subtraction_leaves_the_difference():
    a, b = np.arange(10, 60, dtype=np.uint64), np.arange(13, 61, dtype=np.uint64)
    out, done = Tables(*_flat([a]), 1, 30).minus(Tables(*_flat([b]), 1, 30)).peel()
    assert done.all() and out.tolist() == [4]


def test_odd_rows(spark, odd, none):
    found = fingerprint_versions(odd).collect()
    assert len(found) == odd.count() and Counter(r.doc_id for r in found) == Counter(r.doc_id for r in odd.collect())
    assert fingerprint_versions(none).count() == 0
    one = spark.createDataFrame([(5, "a b c")], "doc_id long, text string")
    check(fingerprint_versions(one).collect(), plain([(5, "a b c")]))
    rows = [(i, t) for i, t in enumerate(["", "x", None, "ab\n\n ab\nab", "\U0001f600" * 5, "w " * 4000, "w " * 4000])]
    check(fingerprint_versions(spark.createDataFrame(rows, "doc_id long, text string"), bytes_per_partition=64).collect(), plain([(i, t or "") for i, t in rows]))
    assert edited("abcde", "xyz") == "abcxy" and edited("abcdef", "x") == "abcx"
