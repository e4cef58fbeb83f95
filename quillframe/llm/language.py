"""Language identification by interpolated Kneser-Ney character models.

Grams of ``ORDER`` symbols are counted per language in Spark, over a sample of labelled rows that is bounded by a documented
number of characters per language. From their counts the driver forms one table per order: a sorted array of gram hashes
with the log-probability in each language beside it, and a sorted array of context hashes with the log back-off
weights. Tasks look every position of a text up in them; only grams that no language has seen go down to the next
order. The language with the lowest cross-entropy per symbol is chosen. A text is rejected if that entropy
lies beyond the middle between right and wrong languages, as measured on labelled rows that were not counted, with an
allowance for short texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from quillframe.functions.sizing import broadcast_if_small, store
from quillframe.llm.common import arrow_schema, column, fresh, slices

ORDER = 4
UNKNOWN = "und"
BLOCK = 1 << 19  # positions looked up at a time
_MIX = np.random.Generator(np.random.PCG64(20)).integers(1, 1 << 63, ORDER, dtype=np.uint64) | np.uint64(1)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(code).isalpha() for code in range(0x110000)), dtype=bool, count=0x110000)


def symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of all texts in a row and the number of symbols of each, without the lead.

    A symbol is the code of a lower-case letter, or 0 for what ends a word. ``ORDER - 1`` zeros lead each text.
    """
    lead = "\n" * (ORDER - 1)
    coded = [np.frombuffer(f"{lead}{text.lower()}\n".encode("utf-32-le", "replace"), dtype="<u4") for text in texts]
    codes = np.concatenate(coded)
    starts = np.cumsum([0, *map(len, coded[:-1])])
    letter = _letters()[codes]
    kept = letter.copy()
    kept[1:] |= letter[:-1]
    for i in range(ORDER - 1):
        kept[starts + i] = True
    counts = np.add.reduceat(kept, starts, dtype=np.int64)
    return np.where(letter, codes, 0)[kept].astype(np.uint64), counts - (ORDER - 1)


def hashes(row: np.ndarray) -> list[np.ndarray]:
    """For each order from 1, the hash of the gram that ends at each position after the first ``ORDER - 1``."""
    size, total, found = len(row) - ORDER + 1, np.uint64(0), []
    for back in range(ORDER):
        total = total + (row[ORDER - 1 - back : ORDER - 1 - back + size] + np.uint64(1)) * _MIX[back]
        found.append(total)
    return found


@dataclass
class KneserNey:
    """Per order: sorted gram hashes with log-probabilities, sorted context hashes with log back-off weights."""

    languages: list[str]
    alphabet: int
    grams: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    contexts: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    rejects_above: np.ndarray | None = None
    spread: np.ndarray | None = None

    def log_probabilities(self, row: np.ndarray) -> np.ndarray:
        """One row per position after the lead, one column per language."""
        keys = hashes(row)
        result = np.zeros((len(keys[0]), len(self.languages)), dtype=np.float32)
        open_ = np.arange(len(result))
        for order in range(ORDER, 0, -1):
            table, values = self.grams[order - 1]
            key = keys[order - 1][open_]
            at = np.minimum(np.searchsorted(table, key), len(table) - 1)
            hit = table[at] == key
            if hit.all():
                result[open_] += values[at]
                return result
            result[open_[hit]] += values[at[hit]]
            open_ = open_[~hit]
            table, values = self.contexts[order - 1]
            key = (keys[order - 1] - keys[0])[open_]
            at = np.minimum(np.searchsorted(table, key), len(table) - 1)
            known = table[at] == key
            result[open_[known]] += values[at[known]]
        result[open_] -= np.float32(np.log(self.alphabet))
        return result

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The cross-entropy per symbol in each language, and the number of symbols, of each text. Texts without letters have no symbols."""
        row, counts = symbols(texts)
        sums = np.zeros((len(texts), len(self.languages)))
        ends = np.cumsum(counts + ORDER - 1)
        of_text = np.repeat(np.arange(len(texts)), counts + ORDER - 1)
        for at in range(ORDER - 1, len(row), BLOCK):
            to = min(len(row), at + BLOCK)
            logs = self.log_probabilities(row[at - ORDER + 1 : to])
            owner = of_text[at:to]
            # the leads of later texts are contexts only
            logs[np.arange(at, to) - (ends - counts - ORDER + 1)[owner] < ORDER - 1] = 0
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            sums[owner[first]] += np.add.reduceat(logs, first, axis=0, dtype=np.float64)
        return -sums / np.maximum(counts, 1)[:, None], counts


def _discount(counts: np.ndarray) -> float:
    once, twice = np.count_nonzero(counts == 1), np.count_nonzero(counts == 2)
    return once / (once + 2 * twice) if once else 0.1


def kneser_ney(counted: list[tuple[str, str, int]]) -> KneserNey:
    """Models from ``(language, gram of ORDER symbols, count)``."""
    languages = sorted({language for language, _, _ in counted})
    number = {language: i for i, language in enumerate(languages)}
    grams = np.array([[ord(c) for c in gram] for _, gram, _ in counted], dtype=np.uint64)
    of = np.array([number[language] for language, _, _ in counted])
    counts = np.array([count for _, _, count in counted], dtype=np.float64)
    model = KneserNey(languages, len(np.unique(grams[:, -1])) + 1)
    weighted = (grams[:, ::-1] + np.uint64(1)) * _MIX  # by distance from the last symbol
    levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
    rows, lang, count = weighted, of, counts
    for order in range(ORDER, 0, -1):
        levels.append((rows[:, :order].sum(axis=1), rows[:, 0], lang, count, rows))
        if order == 1:
            break
        # the next order counts the kinds of symbols before a gram
        shorter = rows[:, : order - 1].sum(axis=1)
        keyed = shorter ^ (lang.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        _, first, kinds = np.unique(keyed, return_index=True, return_counts=True)
        rows, lang, count = rows[first], lang[first], kinds.astype(np.float64)
    lower = np.full((0, len(languages)), 0.0)
    table = np.zeros(0, np.uint64)
    for order, (gram, last, lang, count, rows) in enumerate(reversed(levels), 1):
        table_n, place = np.unique(gram, return_inverse=True)
        context = gram - last
        contexts, of_context = np.unique(context, return_inverse=True)
        mass = np.zeros((len(table_n), len(languages)))
        total = np.zeros((len(contexts), len(languages)))
        kinds = np.zeros_like(total)
        discount = np.array([_discount(count[lang == i]) for i in range(len(languages))])
        np.add.at(total, (of_context, lang), count)
        np.add.at(kinds, (of_context, lang), 1)
        mass[place, lang] = np.maximum(count - discount[lang], 0)
        context_of_gram = np.zeros(len(table_n), np.int64)
        context_of_gram[place] = of_context
        with np.errstate(divide="ignore", invalid="ignore"):
            backoff = np.where(total > 0, discount * kinds / total, 1.0)
            share = np.where(total[context_of_gram] > 0, mass / total[context_of_gram], 0.0)
        if order == 1:
            below = np.full((len(table_n), len(languages)), 1.0 / model.alphabet)
        else:
            suffix = np.zeros(len(table_n), np.uint64)
            suffix[place] = gram - rows[:, order - 1]
            below = lower[np.searchsorted(table, suffix)]
        probability = share + backoff[context_of_gram] * below
        model.grams.append((table_n, np.log(probability).astype(np.float32)))
        model.contexts.append((contexts, np.log(backoff).astype(np.float32)))
        table, lower = table_n, probability
    return model


def _share(keys: list[Column], salt: str) -> Column:
    """A number from 0 to 1 from the hash of the keys."""
    return F.pmod(F.xxhash64(*keys, F.lit(salt)), F.lit(1 << 30)) / float(1 << 30)


def train(docs: DataFrame, *, letters_per_language: int = 1_500_000, calibration_docs: int = 1_000) -> KneserNey | None:
    """Models of all values of ``lang`` in ``docs`` that are not NULL; None if there is no labelled text with a letter.

    ``letters_per_language`` bounds, on average, the characters that are counted of one language, and ``calibration_docs`` the
    texts per language that the rejection is set by. Both samples are drawn by the hash of ``doc_id`` and text, four fifths of
    the rows being open to the one and a fifth to the other, so that no text sets its own threshold.
    """
    spark = docs.sparkSession
    keys = [column(docs, "doc_id").cast("string"), column(docs, "text", "string")]
    labelled = docs.where(column(docs, "lang").isNotNull() & column(docs, "text").isNotNull()).select(
        column(docs, "lang", "string").alias("lang"), column(docs, "text", "string").alias("text"), (_share(keys, "role") < 0.8).alias("counted"), _share(keys, "draw").alias("draw")
    )
    totals = labelled.groupBy(F.col("lang").alias("of"), F.col("counted").alias("part")).agg(F.sum(F.length("text")).alias("letters"), F.count("*").alias("texts"))
    rates = store(totals.select("of", "part", F.when(F.col("part"), F.lit(float(letters_per_language)) / F.greatest("letters", F.lit(1))).otherwise(F.lit(float(calibration_docs)) / F.col("texts")).alias("rate")))
    drawn = labelled.join(broadcast_if_small(rates), (F.col("lang") == F.col("of")) & (F.col("counted") == F.col("part"))).where(F.col("draw") < F.col("rate"))
    sample = store(drawn.select("lang", "text", "counted"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            names = np.array(batch["lang"].to_pylist(), dtype=object)
            texts = batch["text"].to_pylist()
            for name in sorted(set(names)):
                row, counts = symbols([texts[i] for i in np.flatnonzero(names == name)])
                ends = np.cumsum(counts + ORDER - 1)
                inside = np.ones(len(row), bool)
                for i in range(ORDER - 1):
                    inside[ends - counts - ORDER + 1 + i] = False
                places = np.flatnonzero(inside)
                if len(places):
                    key = hashes(row)[-1][places - ORDER + 1]
                    _, first, found = np.unique(key, return_index=True, return_counts=True)
                    windows = np.lib.stride_tricks.sliding_window_view(row, ORDER)[places[first] - ORDER + 1]
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(found)), pa.array(["".join(map(chr, w)) for w in windows.tolist()]), pa.array(found)], names=["lang", "gram", "n"])

    counted = sample.where("counted").select("lang", "text").mapInArrow(count, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    found = [tuple(row) for row in counted.collect()]  # bounded by the sample
    if not found:
        return None
    model = kneser_ney(sorted(found))
    shared = spark.sparkContext.broadcast(model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            entropy, counts = shared.value.entropies(batch["text"].to_pylist())
            yield pa.RecordBatch.from_arrays([batch["lang"], pa.array(entropy.tolist(), pa.list_(pa.float64())), pa.array(counts)], names=["lang", "entropy", "n"])

    measured = sample.where(~F.col("counted")).select("lang", "text").mapInArrow(measure, "lang string, entropy array<double>, n long").where("n > 0").collect()
    _calibrate(model, [(row.lang, np.array(row.entropy), row.n) for row in measured])
    return model


def _calibrate(model: KneserNey, measured: list[tuple[str, np.ndarray, int]]) -> None:
    """Set the entropy above which a text of each language is rejected, and the spread of one symbol."""
    names = model.languages
    model.rejects_above = np.full(len(names), np.inf)
    model.spread = np.zeros(len(names))
    for i, name in enumerate(names):
        right = np.array([(entropy[i], n) for lang, entropy, n in measured if lang == name]).reshape(-1, 2)
        wrong = np.array([(entropy[i], n) for lang, entropy, n in measured if lang != name]).reshape(-1, 2)
        if len(right):
            level = np.average(right[:, 0], weights=right[:, 1])
            other = np.average(wrong[:, 0], weights=wrong[:, 1]) if len(wrong) else np.log(model.alphabet)
            model.spread[i] = np.sqrt(np.mean((right[:, 0] - level) ** 2 * right[:, 1]))
            # at least as far as any right text lies, with room for those not seen
            model.rejects_above[i] = max(level + (other - level) / 2, 1.1 * right[right[:, 1] >= 20, 0].max(initial=0.0))


def identify(docs: DataFrame, model: KneserNey | None) -> DataFrame:
    """All columns of ``docs`` and ``lang_pred, score, rejected``; only ``text`` is looked at.

    ``lang_pred`` is the learned language with the lowest cross-entropy per symbol, ties going to the first by name, and ``score``
    its share among all when each is weighted by its likelihood per symbol, raised to the root of the length. A text
    that is NULL or has no letter is ``und`` with score 0 and rejected. Without a model every text is ``und`` with score 0 and
    only texts without letters are rejected. Columns of these names in ``docs`` are replaced. An empty table gives no rows.
    """
    names = ("lang_pred", "score", "rejected")
    kept = docs.drop(*names)
    text = "text" if dict(kept.dtypes).get("text") == "string" else fresh(docs, "lang_text")
    if text != "text":
        kept = kept.withColumn(text, column(docs, "text", "string"))
    schema = T.StructType([*kept.schema.fields, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType()), T.StructField(names[2], T.BooleanType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = arrow_schema(schema)
        for batch in slices(batches, text):
            found = _judged(shared.value, batch[text].to_pylist())
            made = [pa.array(values, target.field(name).type) for values, name in zip(found, names)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], schema=target)

    predicted = kept.mapInArrow(predict, schema)
    return predicted if text == "text" else predicted.drop(text)


def _judged(model: KneserNey | None, texts: list[str | None]) -> tuple[list[str], list[float], list[bool]]:
    """Language, score and rejection of each text."""
    texts = [text or "" for text in texts]
    if model is None:
        return [UNKNOWN] * len(texts), [0.0] * len(texts), [not any(map(str.isalpha, t)) for t in texts]
    entropy, counts = model.entropies(texts)
    best = entropy.argmin(axis=1)
    least = entropy[np.arange(len(texts)), best]
    score = 1 / np.exp(-(entropy - least[:, None]) * np.sqrt(counts)[:, None]).sum(axis=1)
    limit = model.rejects_above[best] + 4 * model.spread[best] / np.sqrt(np.maximum(counts, 1))
    empty = counts == 0
    return [UNKNOWN if e else model.languages[b] for e, b in zip(empty, best)], np.where(empty, 0.0, score).tolist(), (empty | (least > limit)).tolist()


def keep_identified(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, with their columns, whose language is not rejected by models trained on the rows with a ``lang``."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, **options))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield batch.filter(pa.array([not gone for gone in _judged(shared.value, batch["text"].to_pylist())[2]]))

    return docs.mapInArrow(keep, docs.schema)
