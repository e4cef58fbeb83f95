"""Byte-level BPE by an index of pair occurrences, and decoding.

Texts are cut at added tokens and split into words as the vocabulary file says. All different words of a slice of a partition
are then merged together: an index maps each pair of neighbouring symbols, by its rank, to all its positions in the slice; the
active ranks are taken in ascending order from a heap, each is applied at its positions from left to right, and the
neighbours' new pairs enter the lists of their own ranks. A merge touches its positions only, so a word of a million letters
takes hardly more than linear time, where searching the lowest pair again after each merge would be quadratic.

Words already merged are kept per Python worker in a table of bounded size; it saves time and decides nothing.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from quillframe.errors import TableError
from quillframe.llm.common import arrow_schema, column, slices

# Fixed value: how this kind of vocabulary splits texts into words.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_BITS = 24  # of a symbol in a pair's key
_BREAK, _GONE = -1, -2
_KEPT_WORDS = 1 << 19
_SLICE_ROWS, _SLICE_BYTES = 2048, 8 << 20  # the more words are merged together, the less an application of a rank costs


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in vocabulary files of this kind: printable Latin-1 for itself, the rest from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in set(printable)]
    return {byte: chr(byte) for byte in printable} | {byte: chr(256 + i) for i, byte in enumerate(others)}


class Vocabulary:
    """Merges, ids, added tokens and splitting rule of one vocabulary file, in its JSON form."""

    def __init__(self, content: str):
        from tokenizers import Tokenizer

        data = json.loads(content)
        model, ids = data["model"], data["model"]["vocab"]
        letters = byte_letters()
        kind = data["pre_tokenizer"] or {}
        if model["type"] != "BPE" or kind.get("type") != "ByteLevel" or not kind.get("use_regex", True) or data["normalizer"] or model.get("ignore_merges") or model.get("dropout"):
            raise TableError("The vocabulary must be a byte-level BPE without normaliser.")
        if any(token["single_word"] or token["lstrip"] or token["rstrip"] for token in data["added_tokens"]):
            raise TableError("Added tokens must be taken as they stand.")
        self.prefix = " " if kind["add_prefix_space"] else ""
        self.added = {token["content"]: token["id"] for token in data["added_tokens"]}
        # the longest of those that begin at one place, as the first one found wins otherwise
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self.byte_ids = np.array([ids.get(letters[byte], _BREAK) for byte in range(256)], np.int64)
        if (self.byte_ids == _BREAK).any():
            raise TableError("The vocabulary lacks some of the 256 bytes.")
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.parts = [(ids[a], ids[b]) for a, b in merges]
        self.made = [ids[a + b] for a, b in merges]
        keys = np.array([a << _BITS | b for a, b in self.parts] or [-1], np.int64)
        self._keys, self._ranks = np.unique(keys, return_index=True)  # of a pair given twice the first rank
        raw = {letter: byte for byte, letter in letters.items()}
        texts = {i: bytes(raw[c] for c in token) for token, i in ids.items() if all(c in raw for c in token)}
        texts |= {i: token.encode() for token, i in self.added.items()}
        sizes = np.zeros(max(texts) + 1, np.int64)
        for i, text in texts.items():
            sizes[i] = len(text)
        self.sizes, self.starts = sizes, np.cumsum(sizes) - sizes
        self.bytes = np.frombuffer(b"".join(texts[i] for i in sorted(texts)), np.uint8)
        self.names = [str(i) for i in range(len(sizes))]
        self._library = Tokenizer.from_str(content).pre_tokenizer
        self._words = regex.compile(WORDS)
        self._differs = self._other_letters()

    def _other_letters(self) -> frozenset[str]:
        """The characters that are letters or digits here but not in the Unicode version of the vocabulary's own library."""
        found = []
        for lead, kind in (("a", r"\p{L}"), ("1", r"\p{N}")):
            those = regex.findall(kind, "".join(map(chr, [*range(0x80, 0xD800), *range(0xE000, 0x110000)])))
            for at in range(0, len(those), 10_000):
                part = those[at : at + 10_000]
                joined = {start for _, (start, end) in self._library.pre_tokenize_str("".join(f"{lead}{c}\n" for c in part)) if end - start == 2}
                found += [c for i, c in enumerate(part) if 3 * i not in joined]
        return frozenset(found)

    def split(self, text: str) -> list[str]:
        """The words of a text without added tokens."""
        if self.prefix and not text[:1].isspace():
            text = self.prefix + text
        if text.isascii() or self._differs.isdisjoint(text):
            return self._words.findall(text)
        return [text[start:end] for _, (start, end) in self._library.pre_tokenize_str(text)]

    def ranks(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The rank of each pair of symbols, -1 for pairs that are never merged."""
        keys = np.where((first < 0) | (second < 0), -2, first << _BITS | second)
        at = np.minimum(np.searchsorted(self._keys, keys), len(self._keys) - 1)
        return np.where(self._keys[at] == keys, self._ranks[at], -1)

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: their bytes one after the other, broken ones replaced as UTF-8 decoders do."""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        places = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.starts[ids] - (ends - sizes), sizes)
        return self.bytes[places].tobytes().decode("utf-8", "replace")


def merge_words(words: Sequence[str], vocabulary: Vocabulary) -> list[list[int]]:
    """The ids of each word, all words merged together by one index of pair occurrences."""
    raw = "\0".join(words).encode()
    lengths = np.array([len(word.encode()) for word in words], np.int64)
    symbols = np.full(len(raw) + 2, _BREAK, np.int64)
    inner = np.ones(len(raw), bool)
    inner[np.cumsum(lengths + 1)[:-1] - 1] = False
    symbols[1:-1][inner] = vocabulary.byte_ids[np.frombuffer(raw, np.uint8)[inner]]
    after, before = np.arange(1, len(symbols) + 1), np.arange(-1, len(symbols) - 1)
    where: defaultdict[int, list[np.ndarray]] = defaultdict(list)
    active: list[int] = []

    def enter(places: np.ndarray, first: np.ndarray, second: np.ndarray) -> None:
        """Add places to the lists of the ranks that their pairs have."""
        ranks = vocabulary.ranks(first, second)
        known = np.flatnonzero(ranks >= 0)
        if not len(known):
            return
        order = known[np.argsort(ranks[known], kind="stable")]
        ranks, places = ranks[order], places[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(ranks)]):
            rank = int(ranks[start])
            if rank not in where:
                heapq.heappush(active, rank)
            where[rank].append(places[start:end])

    enter(np.arange(len(symbols) - 1), symbols[:-1], symbols[1:])
    while active:
        now = heapq.heappop(active)
        a, b = vocabulary.parts[now]
        lists = where.pop(now)
        places = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
        second = after[places]
        there = (symbols[places] == a) & (symbols[second] == b)  # not so where an earlier merge took one of the two
        places, second = places[there], second[there]
        if a == b and len(places) > 1:  # in a run of equal symbols every other pair, from the left
            first = np.r_[True, second[:-1] != places[1:]]
            index = np.arange(len(places))
            taken = (index - np.maximum.accumulate(np.where(first, index, 0))) % 2 == 0
            places, second = places[taken], second[taken]
        if not len(places):
            continue
        follower = after[second]
        symbols[places], symbols[second] = vocabulary.made[now], _GONE
        after[places], before[follower] = follower, places
        left = before[places]
        enter(np.concatenate([left, places]), np.concatenate([symbols[left], symbols[places]]), np.concatenate([symbols[places], symbols[follower]]))
    left_over = symbols[1:][symbols[1:] != _GONE]
    ends = np.flatnonzero(left_over == _BREAK)
    ids = left_over.tolist()
    return [ids[start:end] for start, end in zip([0, *(ends[:-1] + 1).tolist()], ends.tolist())][: len(words)]


class Encoder:
    """Encodes texts slice by slice; what differs between slices is only which words are already known."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self._known: dict[str, list[int]] = self._added()

    def _added(self) -> dict[str, list[int]]:
        return {token: [i] for token, i in self.vocabulary.added.items()}

    def encode(self, texts: Sequence[str]) -> list[list[int]]:
        split = [self._pieces(text) for text in texts]
        present = {word for words in split for word in words}
        fresh = [word for word in present if word not in self._known]
        if len(self._known) + len(fresh) > _KEPT_WORDS:
            self._known = {word: ids for word, ids in self._known.items() if word in present} | self._added()
        self._known |= zip(fresh, merge_words(fresh, self.vocabulary))
        known = self._known
        return [[i for word in words for i in known[word]] for words in split]

    def _pieces(self, text: str) -> list[str]:
        """Words and added tokens in their order. No word can look like an added token, as those are cut out first."""
        vocabulary = self.vocabulary
        if vocabulary.cut is None or not vocabulary.cut.search(text):
            return vocabulary.split(text) if text else []
        words, at = [], 0
        for match in vocabulary.cut.finditer(text):
            if match.start() > at:
                words += vocabulary.split(text[at : match.start()])
            words.append(match.group())
            at = match.end()
        return words + (vocabulary.split(text[at:]) if at < len(text) else [])


def encode_documents(docs: DataFrame, vocabulary: str, *, with_ids: bool = True) -> DataFrame:
    """Encode every whole text and decode it again.

    ``vocabulary`` is the content of a vocabulary file (JSON, byte-level BPE); it is shipped to the tasks, which need no file.
    Ids and text are those of the ``tokenizers`` library with ``add_special_tokens=False`` and ``skip_special_tokens=False``;
    added tokens in a text become their own id, truncation and padding of the file are not used.

    One row per document: ``doc_id, n_tokens, ids_sha256`` (of the decimal ids, joined by commas), ``decoded_sha256`` (of the
    decoded text) and, if asked for, ``ids`` and ``decoded``. NULL and empty texts have no ids. Rows with a NULL or repeated
    ``doc_id`` and repeated rows stay rows of their own; texts have any length that a row can hold, words as well. An
    empty table gives no rows. Other columns are not read, whatever their names.
    """
    schema = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType()),
    ])
    if with_ids:
        schema = schema.add("ids", T.ArrayType(T.IntegerType())).add("decoded", T.StringType())
    shipped = docs.sparkSession.sparkContext.broadcast(vocabulary)  # a file of fixed size

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, target = _loaded(shipped), arrow_schema(schema)
        names = encoder.vocabulary.names
        for batch in slices(batches, rows=_SLICE_ROWS, size_limit=_SLICE_BYTES):
            ids = encoder.encode(batch["text"].to_pylist())
            decoded = [encoder.vocabulary.decode(np.array(row, np.int64)) for row in ids]
            columns = {
                "doc_id": batch["doc_id"].cast(target.field("doc_id").type), "n_tokens": [len(row) for row in ids],
                "ids_sha256": [hashlib.sha256(",".join([names[i] for i in row]).encode()).hexdigest() for row in ids],
                "decoded_sha256": [hashlib.sha256(text.encode()).hexdigest() for text in decoded], "ids": ids, "decoded": decoded,
            }
            yield pa.RecordBatch.from_pydict({name: columns[name] for name in target.names}, schema=target)

    source = docs.select(column(docs, "doc_id").alias("doc_id"), F.coalesce(column(docs, "text", "string"), F.lit("")).alias("text"))
    return source.mapInArrow(encode, schema)


_LOADED: dict[int, Encoder] = {}  # of this Python worker, for its later tasks


def _loaded(shipped) -> Encoder:
    content = shipped.value
    key = hash(content)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Encoder(Vocabulary(content))
    return _LOADED[key]
