"""Scoring documents by masked pseudo-likelihood.

A small network reads the two tokens on either side of a position and gives the probability of the token between them.
The summed log-probability of all tokens of a document, each masked in turn, is its score. The vocabulary comes from word counts
over the whole corpus. Training passes over every position of every document once: in each round the tasks train on their share of the round's
documents from the same parameters, which are then averaged by a tree of grouped sums.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from quillframe.functions.sizing import store
from quillframe.llm.common import arrow_schema, column, slices

SIDE = 2  # tokens that are looked at on either side
CLASSES = 32
FREQUENT, RARE = 768, 256  # words with a token of their own, and tokens that all others share by their endings
TOKENS = FREQUENT + RARE
WIDTH, HIDDEN = 16, 32
BATCH = 2048
BLOCK = 1 << 11
GROUP = 32  # parameter sets that are summed in one task
FLUSH = 1_000_000  # words that a task counts at once

SHAPES = {
    "embed": (TOKENS + 1, WIDTH), "mix": (2 * SIDE * WIDTH, HIDDEN), "mix_bias": (HIDDEN,), "of_class": (HIDDEN, CLASSES), "class_bias": (CLASSES,),
    "inside": (CLASSES, HIDDEN, TOKENS // CLASSES), "inside_bias": (CLASSES, TOKENS // CLASSES),
}


def initial(seed: int) -> dict[str, np.ndarray]:
    draw = np.random.default_rng(seed)
    return {name: (np.zeros(shape) if "bias" in name else draw.normal(0, 1 / math.sqrt(shape[-2] if name != "embed" else 4), shape)).astype(np.float32) for name, shape in SHAPES.items()}


def packed(parameters: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([parameters[name].ravel() for name in SHAPES])


def unpacked(flat: np.ndarray) -> dict[str, np.ndarray]:
    parts = np.split(flat, np.cumsum([math.prod(s) for s in SHAPES.values()])[:-1])
    return {name: part.reshape(shape).astype(np.float32) for (name, shape), part in zip(SHAPES.items(), parts)}


def words(texts: list[str]) -> tuple[pa.Array, np.ndarray]:
    """The words of ``text.lower().split()`` of all texts in a row, and how many each text has.

    Arrow splits at the same code points, but also gives the empty strings at the ends of a text.
    """
    split = pc.utf8_split_whitespace(pa.array([text.lower() for text in texts], pa.large_string()))
    found, owner = split.flatten(), pc.list_parent_indices(split)
    real = pc.greater(pc.binary_length(found), 0)
    if not pc.all(real).as_py():
        found, owner = found.filter(real), owner.filter(real)
    return found, np.bincount(owner.to_numpy(), minlength=len(texts))


def encode_all(texts: list[str], vocabulary: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of all texts in a row, and how many each text has. Class and place within the class are the token's remainder and quotient by ``CLASSES``."""
    found, sizes = words(texts)
    tokens = np.empty(len(found), np.int16)
    place = pc.index_in(found, pa.array(list(vocabulary), pa.large_string()))
    known = pc.is_valid(place)
    at = known.to_numpy(zero_copy_only=False)
    tokens[at] = np.array(list(vocabulary.values()), np.int16)[place.drop_null().to_numpy()]
    endings = pc.utf8_slice_codeunits(found.filter(pc.invert(known)), -3).dictionary_encode()
    tokens[~at] = np.array([FREQUENT + zlib.crc32(ending.encode("utf-8")) % RARE for ending in endings.dictionary.to_pylist()], np.int16)[endings.indices.to_numpy()]
    return tokens, sizes


def encode(text: str, vocabulary: dict[str, int]) -> np.ndarray:
    """The tokens of a text."""
    return encode_all([text], vocabulary)[0].astype(np.int64)


def _padded(tokens: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All tokens in a row with blanks around each text, the positions of tokens, and the text of each."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(owner)) + SIDE * (owner + 1)
    row = np.full(len(tokens) + SIDE * (len(sizes) + 1), TOKENS, np.int16)
    row[at] = tokens
    return row, at, owner


def _around(row: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.stack([row[at + step] for step in range(-SIDE, SIDE + 1) if step], axis=1)


class _Room:
    """Arrays by name that each batch uses again: to take new ones from the system costs about as much as to fill them."""

    def __init__(self) -> None:
        self.held: dict[str, np.ndarray] = {}

    def __call__(self, name: str, rows: int, width: int, kind: np.dtype) -> np.ndarray:
        found = self.held.get(name)
        if found is None or len(found) < rows or found.shape[1] != width or found.dtype != kind:
            found = self.held[name] = np.empty((rows, width), kind)
        return found[:rows]


def _added(columns: np.ndarray) -> np.ndarray:
    """The sums over all columns, a multiple of eight, added in the order in which NumPy adds up short rows."""
    sums = columns.reshape(-1, 8, columns.shape[1]).sum(axis=0)
    while len(sums) > 1:
        sums = sums[::2] + sums[1::2]
    return sums[0]


def _log_chance(columns: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The logarithm of the softmax, at one place of each position. Each place has a column, as long ones are worked on faster than short rows. The logits are used up."""
    columns -= columns.max(axis=0)
    found = columns[chosen, np.arange(len(chosen))]
    return found - np.log(_added(np.exp(columns, out=columns)))


def _softmax(logits: np.ndarray) -> np.ndarray:
    """The logits are used up."""
    columns = logits.T.copy()
    columns -= columns.max(axis=0)
    np.exp(columns, out=columns)
    columns /= _added(columns)
    logits[:] = columns.T
    return logits


def _by_class(tokens: np.ndarray) -> tuple[np.ndarray | None, list[tuple[int, slice]]]:
    """An order of the tokens by class, none if they already are in it, and the slice of each class in it."""
    classes, order = (tokens % CLASSES).astype(np.int8), None
    if (classes[1:] < classes[:-1]).any():
        order = np.argsort(classes, kind="stable")
        classes = classes[order]
    bounds = np.searchsorted(classes, np.arange(CLASSES + 1)).tolist()
    return order, [(number, slice(bounds[number], bounds[number + 1])) for number in range(CLASSES) if bounds[number] < bounds[number + 1]]


def _hidden(p: dict[str, np.ndarray], around: np.ndarray, room: _Room) -> tuple[np.ndarray, np.ndarray]:
    """The embeddings around each position, and the hidden layer."""
    kind = p["mix"].dtype
    seen = room("seen", len(around), 2 * SIDE * WIDTH, kind)
    p["embed"].take(around, axis=0, out=seen.reshape(*around.shape, WIDTH), mode="clip")  # which unlike "raise" needs no copy
    hidden = np.matmul(seen, p["mix"], out=room("hidden", len(around), HIDDEN, kind))
    hidden += p["mix_bias"]
    return seen, np.tanh(hidden, out=hidden)


def _classes(p: dict[str, np.ndarray], hidden: np.ndarray, logits: np.ndarray) -> np.ndarray:
    """The logits of the classes."""
    np.matmul(hidden, p["of_class"], out=logits)
    logits += p["class_bias"]
    return logits


def _inside(p: dict[str, np.ndarray], hidden: np.ndarray, classes: list[tuple[int, slice]], logits: np.ndarray) -> np.ndarray:
    """The logits of the places within the class of each row."""
    for number, at in classes:
        part = np.matmul(hidden[at], p["inside"][number], out=logits[at])
        part += p["inside_bias"][number]
    return logits


def log_probabilities(p: dict[str, np.ndarray], around: np.ndarray, tokens: np.ndarray, room: _Room | None = None) -> np.ndarray:
    """The log-probability of each token between the tokens around it."""
    room = room or _Room()
    order, classes = _by_class(tokens)
    if order is not None:
        around, tokens = around[order], tokens[order]
    _, hidden = _hidden(p, around, room)
    columns = room("columns", CLASSES, len(tokens), hidden.dtype)
    found = _log_chance(_classes(p, hidden, columns.T).T, tokens % CLASSES).astype(np.float64)
    columns = room("columns", TOKENS // CLASSES, len(tokens), hidden.dtype)
    found += _log_chance(_inside(p, hidden, classes, columns.T).T, tokens // CLASSES)
    if order is not None:
        found[order] = found.copy()
    return found


def _in_blocks(p: dict[str, np.ndarray], row: np.ndarray, at: np.ndarray, room: _Room) -> np.ndarray:
    """The log-probability of the token at each position of a row. Blocks are taken in the order of the classes, so that each has one class or few."""
    found, order = np.empty(len(at)), np.argsort((row[at] % CLASSES).astype(np.int8), kind="stable")
    for begin in range(0, len(at), BLOCK):
        some = order[begin : begin + BLOCK]
        found[some] = log_probabilities(p, _around(row, at[some]), row[at[some]], room)
    return found


def gradients(p: dict[str, np.ndarray], around: np.ndarray, tokens: np.ndarray, room: _Room | None = None) -> dict[str, np.ndarray]:
    """Of the mean negative log-probability. That of the embeddings is given as rows in the order of ``around``; it lies in ``room``.

    Positions are put in the order of their classes first, so that each class is a slice.
    """
    room = room or _Room()
    size = len(tokens)
    order, classes = _by_class(tokens)
    if order is not None:
        around, tokens = around[order], tokens[order]
    seen, hidden = _hidden(p, around, room)
    out = _softmax(_classes(p, hidden, room("logits", size, CLASSES, hidden.dtype)))
    out.reshape(-1)[np.arange(size) * CLASSES + tokens % CLASSES] -= 1
    out /= size
    back = np.matmul(out, p["of_class"].T, out=room("back", size, HIDDEN, out.dtype))
    found = {"of_class": hidden.T @ out, "class_bias": out.sum(0), "inside": np.zeros_like(p["inside"]), "inside_bias": np.zeros_like(p["inside_bias"])}
    out = _softmax(_inside(p, hidden, classes, room("logits", size, TOKENS // CLASSES, hidden.dtype)))
    out.reshape(-1)[np.arange(size) * (TOKENS // CLASSES) + tokens // CLASSES] -= 1
    out /= size
    behind = room("behind", size, HIDDEN, out.dtype)
    for number, at in classes:
        np.dot(hidden[at].T, out[at], out=found["inside"][number])
        np.add.reduce(out[at], axis=0, out=found["inside_bias"][number])
        np.dot(out[at], p["inside"][number].T, out=behind[at])
    back += behind
    hidden *= hidden
    back *= np.subtract(1, hidden, out=hidden)
    rows = np.matmul(back, p["mix"].T, out=room("rows", size, 2 * SIDE * WIDTH, back.dtype))
    if order is not None:
        rows[order] = rows.copy()
    found |= {"mix": seen.T @ back, "mix_bias": back.sum(0), "embed": rows.reshape(-1, WIDTH)}
    return found


class Trainer:
    """Stochastic descent with a step per parameter that shrinks with what it has moved by."""

    def __init__(self, parameters: dict[str, np.ndarray], rate: float) -> None:
        self.p = {name: values.copy() for name, values in parameters.items()}
        self.squares = {name: np.full_like(values, 1e-6) for name, values in self.p.items()}
        self.rate, self.seen, self.room = rate, 0, _Room()

    def step(self, around: np.ndarray, tokens: np.ndarray) -> None:
        for name, slope in gradients(self.p, around, tokens, self.room).items():
            if name == "embed":
                slope = self._by_token(around.ravel().astype(np.int64), slope)
            self.squares[name] += slope * slope
            self.p[name] -= self.rate * slope / np.sqrt(self.squares[name])
        self.seen += len(tokens)

    def _by_token(self, tokens: np.ndarray, slope: np.ndarray) -> np.ndarray:
        parts = self.room("parts", WIDTH, len(slope), np.dtype(np.float64))
        parts[:] = slope.T
        sums = np.empty((TOKENS + 1, WIDTH), np.float32)
        for i, part in enumerate(parts):
            sums[:, i] = np.bincount(tokens, part, TOKENS + 1)
        return sums


def count_words(texts: DataFrame) -> DataFrame:
    """``word, n`` over all rows of ``text``. Tasks hand on the counts of what they have read."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in slices(batches):
            if len(found := words(batch["text"].to_pylist())[0]):
                held.append(found)
                size += len(found)
            if size > FLUSH:
                yield _counted(held)
                held, size = [], 0
        if held:
            yield _counted(held)

    return texts.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _counted(held: list[pa.Array]) -> pa.RecordBatch:
    found = pa.chunked_array(held).value_counts()
    return pa.RecordBatch.from_arrays([found.field("values").cast(pa.string()), found.field("counts")], names=["word", "n"])


def _summed(parts: DataFrame) -> tuple[np.ndarray, int] | None:
    """The mean of the parameter sets by the positions that each has seen, summed a few at a time."""

    def add(_: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("number")
        total = sum(np.frombuffer(values, np.float64) for values in rows["values"].to_pylist())
        return pa.table({"number": pa.array([rows["number"][0].as_py() // GROUP], pa.int64()), "seen": pa.array([sum(rows["seen"].to_pylist())], pa.int64()), "values": pa.array([total.tobytes()], pa.binary())})

    schema = "number long, seen long, values binary"
    while True:
        parts = store(parts.groupBy(F.floor(F.col("number") / GROUP).alias("of")).applyInArrow(add, schema))
        if parts.count() <= GROUP:
            break
    rows = parts.orderBy("number").collect()  # at most GROUP sets of fixed size
    seen = sum(row.seen for row in rows)
    return (sum(np.frombuffer(row["values"], np.float64) for row in rows) / seen, seen) if seen else None


def train(docs: DataFrame, *, rounds: int = 3, rate: float = 0.1, seed: int = 11) -> tuple[dict[str, int], dict[str, np.ndarray]]:
    """A vocabulary and the parameters of the network, from all rows of ``docs``, each of which one round trains on."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(column(docs, "text", "string"), F.lit("")).alias("text"), F.xxhash64(column(docs, "doc_id").cast("string"), column(docs, "text", "string")).alias("draw"))
    top = count_words(texts.select("text")).orderBy(F.desc("n"), "word").limit(FREQUENT).collect()
    vocabulary = {row.word: i for i, row in enumerate(top)}
    parameters = initial(seed)
    known = spark.sparkContext.broadcast(vocabulary)
    for number in range(rounds):
        shared = spark.sparkContext.broadcast(packed(parameters))
        part = texts.where(F.pmod("draw", F.lit(rounds)) == number).withColumn("part", F.spark_partition_id())
        found = _summed(part.mapInArrow(_descend(known, shared, rate / (1 + number)), "number long, seen long, values binary"))
        if found:
            parameters = unpacked(found[0])
    return vocabulary, parameters


def _descend(known, shared, rate: float):
    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer, part = Trainer(unpacked(shared.value), rate), None
        for batch in slices(batches):
            part = batch["part"][0].as_py() if part is None else part
            row, at, _ = _padded(*encode_all(batch["text"].to_pylist(), known.value))
            at = np.random.default_rng(len(row)).permutation(at)
            for begin in range(0, len(at), BATCH):
                some = at[begin : begin + BATCH]
                some = some[np.argsort((row[some] % CLASSES).astype(np.int8), kind="stable")]
                trainer.step(_around(row, some), row[some])
        if trainer.seen:
            yield pa.RecordBatch.from_arrays([
                pa.array([part], pa.int64()), pa.array([trainer.seen], pa.int64()), pa.array([(packed(trainer.p).astype(np.float64) * trainer.seen).tobytes()], pa.binary()),
            ], names=["number", "seen", "values"])

    return descend


def score(docs: DataFrame, vocabulary: dict[str, int], parameters: dict[str, np.ndarray]) -> DataFrame:
    """``doc_id, n_tokens, log_likelihood, score`` of each row.

    ``log_likelihood`` sums the log-probability of every token given the tokens on both of its sides; ``score`` is that per
    token. A text that is NULL or has no word has no tokens, sum 0 and score NULL. Repeated rows are scored like any
    other. An empty table gives no rows. Other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, packed(parameters)))
    schema = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("n_tokens", T.LongType()), T.StructField("log_likelihood", T.DoubleType()), T.StructField("score", T.DoubleType()),
    ])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = arrow_schema(schema)
        vocabulary_, p, room = shared.value[0], unpacked(shared.value[1]), _Room()
        for batch in slices(batches):
            tokens, counts = encode_all([text or "" for text in batch["text"].to_pylist()], vocabulary_)
            row, at, owner = _padded(tokens, counts)
            sums = np.bincount(owner, _in_blocks(p, row, at, room), minlength=len(counts))
            means = [s / n if n else None for s, n in zip(sums.tolist(), counts.tolist())]
            yield pa.RecordBatch.from_arrays([batch["doc_id"].cast(target.field(0).type), pa.array(counts), pa.array(sums), pa.array(means, pa.float64())], schema=target)

    return docs.select(column(docs, "doc_id").alias("doc_id"), column(docs, "text", "string").alias("text")).mapInArrow(judge, schema)


def pseudo_likelihood(docs: DataFrame, **options) -> DataFrame:
    """Train on ``docs`` and score them. See ``train`` and ``score``."""
    return score(docs, *train(docs, **options))
