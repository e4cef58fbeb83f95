from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from quillframe.llm.language import ORDER, identify, keep_identified, kneser_ney, symbols, train
from quillframe.llm.queries import REGISTRY, documents


def test_a_table(spark):
    folder = "/root/testdata/sf0.01"
    docs = {r.doc_id: r for r in documents(spark, folder).collect()}
    found = REGISTRY["op3_language_id"][0](spark, folder).collect()
    assert Counter(r.doc_id for r in found) == Counter(list(docs))
    held = [r for r in found if r.held_out]
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.lang_pred in {"de", "en", "es", "fr"}
    right = np.mean([docs[r.doc_id].lang == r.lang_pred for r in held])
    assert len(held) > 200 and right > 0.98
    assert sum(r.rejected for r in found) <= 0.002 * len(found)


def plain_kneser_ney(counted, order):
    """The probability of a symbol after a context in one language, by the textbook recursion."""
    levels = {order: Counter(dict(counted))}
    for n in range(order - 1, 0, -1):
        levels[n] = Counter(gram[1:] for gram in levels[n + 1])

    def discount(n):
        once, twice = (sum(1 for c in levels[n].values() if c == k) for k in (1, 2))
        return once / (once + 2 * twice) if once else 0.1

    def probability(gram, alphabet):
        n = len(gram)
        below = probability(gram[1:], alphabet) if n > 1 else 1 / alphabet
        after = {g: c for g, c in levels[n].items() if g[:-1] == gram[:-1]}
        if not after:
            return below
        total, d = sum(after.values()), discount(n)
        return max(after.get(gram, 0) - d, 0) / total + d * len(after) / total * below

    return probability


def test_probabilities_against_the_recursion():
    texts = {"a": "banana bandana ban an", "b": "cabbage cab back bag"}
    counted = []
    for lang, text in texts.items():
        row, _ = symbols([text])
        grams = Counter("".join(map(chr, row[i : i + ORDER].tolist())) for i in range(len(row) - ORDER + 1))
        counted += [(lang, gram, n) for gram, n in grams.items()]
    model = kneser_ney(sorted(counted))
    probe = "ban cabana zeb"
    row, _ = symbols([probe])
    found = np.exp(model.log_probabilities(row))
    for j, lang in enumerate(("a", "b")):
        plain = plain_kneser_ney([(g, n) for name, g, n in counted if name == lang], ORDER)
        for i in range(len(row) - ORDER + 1):
            assert math.isclose(found[i, j], plain("".join(map(chr, row[i : i + ORDER].tolist())), model.alphabet), rel_tol=1e-4)


def test_a_text_is_judged_alone():
    row, _ = symbols(["banana bandana", "xyz"])
    grams = Counter("".join(map(chr, row[i : i + ORDER].tolist())) for i in range(11))
    model = kneser_ney(sorted(("a", g, n) for g, n in grams.items()))
    alone = [model.entropies([t])[0][0, 0] for t in ("banana", "", "Zeta ban", "  ")]
    together = model.entropies(["banana", "", "Zeta ban", "  "])[0][:, 0]
    assert np.allclose(alone, together)


def test_foreign_text_is_rejected(spark, folder):
    docs = documents(spark, folder)
    model = train(docs)
    strange = spark.createDataFrame([(1, "привет мир это русский текст без букв тех языков " * 5), (2, "zqxj kvwq xxjz qqkz wvxq jzkq " * 20), (3, "12 34 !!"), (4, None)], "doc_id long, text string")
    found = {r.doc_id: r for r in identify(strange, model).collect()}
    assert all(found[i].rejected for i in (1, 2, 3, 4))
    assert found[3].lang_pred == found[4].lang_pred == "und" and found[4].score == 0


def test_odd_rows(spark, odd, none):
    found = identify(odd, train(odd)).collect()
    assert len(found) == odd.count()
    by_text = defaultdict(set)
    for r in found:
        assert r.lang_pred in {"en", "fr", "und"}
        by_text[r.text].add((r.lang_pred, r.score, r.rejected))
        if not any(map(str.isalpha, r.text or "")):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
    assert all(len(v) == 1 for v in by_text.values())
    kept = keep_identified(odd)
    assert kept.columns == odd.columns and kept.where("text IS NULL").count() == 0
    assert train(none) is None and identify(none, None).count() == 0 and keep_identified(none).count() == 0


@pytest.mark.parametrize("name", ["lang_pred", "score"])
def test_clashing_columns_survive(spark, folder, name):
    docs = documents(spark, folder).selectExpr("*", f"'kept' AS {name}")
    kept = keep_identified(docs)
    assert kept.columns == docs.columns and {r[0] for r in kept.select(name).distinct().collect()} == {"kept"}
