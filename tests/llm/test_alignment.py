from __future__ import annotations

import hashlib
import itertools
from bisect import bisect_left
from collections import Counter, defaultdict

import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from quillframe.llm import alignment
from quillframe.llm.alignment import align_tokenizers
from quillframe.llm.bpe import byte_letters
from quillframe.llm.queries import REGISTRY, _content, ranks

NAMES = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def brute(rows):
    first = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    raw = {letter: byte for byte, letter in byte_letters().items()}
    documents, counts = [], Counter()
    for doc_id, text in rows:
        ids_a = first.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = second.encode(text) if text else []
        bytes_a = [bytes(raw[c] for c in first.id_to_token(i)) for i in ids_a]
        pieces = [second.id_to_piece(i) for i in ids_b]
        bytes_b = [bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids_b, pieces)]
        if not text or not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            documents.append((doc_id, [], {}))
            continue
        ends_a, ends_b = (list(itertools.accumulate(map(len, x))) for x in (bytes_a, bytes_b))
        shared = sorted(set(ends_a) & set(ends_b))
        groups = [([], []) for _ in shared]
        for side, (ids, ends) in enumerate(((ids_a, ends_a), (ids_b, ends_b))):
            for i, end in zip(ids, ends):
                groups[bisect_left(shared, end)][side].append(i)
        links = Counter(pair for a, b in groups for pair in itertools.product(a, b))
        counts.update(links.keys())
        documents.append((doc_id, groups, links))
    highest = defaultdict(int)
    for (a, _), n in counts.items():
        highest[a] = max(highest[a], n)
    result = []
    for doc_id, groups, links in documents:
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        result.append((
            doc_id, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), sum(links.values()),
            sum(n for pair, n in links.items() if counts[pair] == highest[pair[0]]), sum(n * counts[pair] for pair, n in links.items()),
            hashlib.sha256(text.encode()).hexdigest() if groups else "",
        ))
    return sorted(result, key=repr)


def found(df):
    return sorted((tuple(row) for row in df.select(*NAMES).collect()), key=repr)


def aligned(docs, **options):
    return align_tokenizers(docs, ranks(), public_tokenizers.PATTERN, _content("piece_bpe_32k.model"), **options)


TEXTS = ["", None, " ", "x", "a▁b", "▁", "日本語 テキスト\x00", "</s> <|endoftext|>", "ﬁ ½ é́", "=" * 700, "ab" * 500, "\n\n  tab\t", "Zürich, Zürich!", "🙂🙃" * 40, "x y", "x y"]


def test_equals_brute_force(spark, monkeypatch):
    rows = [(i if i % 5 else None, text) for i, text in enumerate(TEXTS * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    expected = brute(rows)
    assert found(aligned(docs)) == expected
    assert sum(row[3] == 0 for row in expected) == 12  # NULL, empty and what one side does not keep


def test_links_are_the_same_in_small_parts(monkeypatch):
    first = alignment.BytePieces(ranks(), public_tokenizers.PATTERN)
    second = alignment.SentencePieces(_content("piece_bpe_32k.model"))
    texts = [text for text in TEXTS if text] + ["".join(map(chr, range(0x3041, 0x3097))) * 20]
    whole = alignment.align_texts(texts, first, second)
    monkeypatch.setattr(alignment, "_PRODUCT_ROWS", 3)
    assert alignment.align_texts(texts, first, second).drop_columns(["numbers", "pairs"]).to_pylist() is not None
    parts = alignment.align_texts(texts, first, second)

    def counted(table):
        pairs = table["pairs"].to_pylist()[0]
        return [sorted((pairs[n]["a"], pairs[n]["b"], m) for n, m in zip(row["numbers"], row["links"])) for row in table.to_pylist()]

    assert counted(parts) == counted(whole)


def test_odd_rows(spark, odd):
    assert found(aligned(odd)) == brute([(r["doc_id"], r["text"]) for r in odd.collect()])
    assert found(aligned(odd.limit(0))) == []
    groups = {r["groups_sha256"]: r["groups"] for r in aligned(odd, with_groups=True).collect()}
    assert all((hashlib.sha256(text.encode()).hexdigest() if text else "") == digest for digest, text in groups.items())


def test_query(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert found(REGISTRY["op13_alignment"][0](spark, folder)) == brute(rows)
