"""Phrase collocation mining by partitioning (SON): complete mining of shards at lowered support, then exact global counts.

1. *Shards.* Each task turns its texts into shards of one language and a bounded number of words: numbers into the shard's own
   list of words, with breaks between pieces. They are written once, so that shards stay the same in all later steps.
2. *Mining.* For phrases of one word, then two, three and four, each shard is mined completely at the support ``ceil(min_count * its
   share of the language's words)``. A phrase with ``min_count`` occurrences reaches that in some shard. Tasks add up the hashed
   local counts of their shards, and Spark those of all tasks, bucket by bucket; where a shard does not report a phrase it can hold at most its local support less one. Phrases whose sum and this
   slack stay below ``min_count`` are out. The hashes of the others, the union of the locally frequent, go into a bit table of fixed
   size. A longer phrase is mined only where both its shorter parts are in the table. Collisions let in too many, never too few.
3. *Counting.* All candidates are counted in all shards by their words, exactly; those below ``min_count`` go. Here as well tasks add up what
   their shards hold and hand it on by bucket.

What is handed on is packed: hashes as steps between 24 bits each below those of their bucket, counts up to ``min_count``, phrases in order.

With few shards the lowered support does most of the pruning. With many it falls to one, and the bit table does: the sum over all
shards is then complete, and only phrases made of frequent parts are counted at the next length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from quillframe.functions.sizing import settle, store
from quillframe.llm.common import arrow_schema, column, slices

LONGEST = 4  # words of a phrase
_BREAK = -1
_TABLE_BITS = 27  # of the table of candidates: 16 MB, at every size of the input
_SEGMENT_BITS = 19
_SLOT_BITS = 24  # of a hash below those of its bucket, which holds the phrases of at most two million words
_HELD = 1 << 19  # local counts that a task adds up before it hands them on
_HELD_PHRASES = 1 << 18  # the same for phrases with their words
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz " + b"\n" * 9)


class _Shard:
    """Words of one language as numbers, until they are written."""

    def __init__(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.parts: list[np.ndarray] = []
        self.words = 0

    def add(self, text: str) -> None:
        raw = text.encode().translate(_FOLD)
        words = raw.split()
        if not words:
            return
        numbers = self.numbers
        ids = np.array([numbers.setdefault(word, len(numbers)) for word in words], np.int32)
        letters = np.frombuffer(raw, np.uint8)
        break_, gap = letters == 10, (letters == 10) | (letters == 32)
        starts = np.flatnonzero(~gap & np.r_[True, gap[:-1]])
        piece = np.cumsum(break_)[starts]
        cuts = np.flatnonzero(piece[1:] != piece[:-1]) + 1
        self.parts += [np.insert(ids, cuts, _BREAK), np.array([_BREAK], np.int32)]
        self.words += len(words)

    def row(self, lang: str) -> dict:
        return {"lang": lang, "words": self.words, "ids": _packed(np.concatenate(self.parts) + np.int32(1)), "vocabulary": b"\n".join(self.numbers)}


def _squeezed(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _raw(squeezed: bytes) -> bytes:
    return pa.decompress(squeezed[8:], decompressed_size=int.from_bytes(squeezed[:8], "little"), codec="zstd", asbytes=True)


def _packed(values: np.ndarray) -> bytes:
    """Numbers, compressed with their bytes of equal weight side by side."""
    return _squeezed(values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes())


def _unpacked(squeezed: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(_raw(squeezed), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


# Numbers (packed) and words (one a line) are bytes to Spark, which only hands them on.
_SHARDS = T.StructType([
    T.StructField("lang", T.StringType()), T.StructField("words", T.LongType()), T.StructField("ids", T.BinaryType()), T.StructField("vocabulary", T.BinaryType()),
])


def _shards(docs: DataFrame, shard_words: int) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, open_ = arrow_schema(_SHARDS), {}

        def written(lang: str) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([open_.pop(lang).row(lang)], schema=target)

        for batch in slices(batches):
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
                open_.setdefault(lang, _Shard()).add(text)
                if open_[lang].words >= shard_words:
                    yield written(lang)
            while sum(shard.words for shard in open_.values()) > 2 * shard_words or len(open_) > 1024:
                yield written(max(open_, key=lambda lang: open_[lang].words))
        for lang in list(open_):
            if open_[lang].words:
                yield written(lang)
            else:
                open_.pop(lang)

    texts = docs.select(F.coalesce(column(docs, "lang", "string"), F.lit("und")).alias("lang"), F.coalesce(column(docs, "text", "string"), F.lit("")).alias("text"))
    return texts.mapInArrow(cut, _SHARDS)


def _mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers over all bits (the finaliser of a common hash function)."""
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def _word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    import xxhash

    seed = xxhash.xxh64_intdigest(lang.encode()) & 0x7FFFFFFF
    return np.array([xxhash.xxh64_intdigest(word, seed) for word in words], np.uint64)


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The hash of a phrase from those of its beginning and its last word."""
    return _mixed(left * np.uint64(0x9E3779B97F4A7C15) + right)


class _Phrases:
    """The phrases of a shard, length by length, kept where the table of candidates has them.

    ``starts`` are places of phrases in the shard's word numbers, ``ends`` of their last words, ``hashes`` their hashes.
    """

    def __init__(self, lang: str, ids: np.ndarray, vocabulary: list[bytes]):
        self.ids = ids
        self.of_word = _word_hashes(lang, vocabulary)
        self.starts = np.flatnonzero(ids != _BREAK)
        self.length, self.hashes = 1, self.of_word[ids[self.starts]]

    def keep(self, table: np.ndarray) -> None:
        kept = _contains(table, self.hashes)
        self.starts, self.hashes = self.starts[kept], self.hashes[kept]

    def lengthen(self) -> None:
        """Phrases of one word more: those of which both the beginning and the end are there."""
        follows = np.flatnonzero(self.starts[1:] == self.starts[:-1] + 1)
        self.length += 1
        self.starts = self.starts[follows]
        self.hashes = _joined(self.hashes[follows], self.of_word[self.ids[self.starts + self.length - 1]])


def _contains(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bits = hashes >> np.uint64(64 - (len(table).bit_length() + 2))  # the table has a power of two of bytes
    return (table[(bits >> np.uint64(3)).astype(np.int64)] >> (bits & np.uint64(7)).astype(np.uint8)) & 1 == 1


_MINED = T.StructType([
    T.StructField("bucket", T.LongType()), T.StructField("lang", T.StringType()), T.StructField("hashes", T.BinaryType()), T.StructField("counts", T.BinaryType()),
])


def _mine(shards: DataFrame, length: int, table, totals, min_count: int, bits: int, short: bool = False) -> DataFrame:
    """Locally frequent phrases of one length, hashes and counts, in buckets by the leading ``bits`` of their hash.

    If ``short``, hashes are the steps between their slots (the ``_SLOT_BITS`` bits after those of the bucket) and counts end at ``min_count``,
    both packed. Phrases that share a slot are then counted as one, which only lets in more.
    """

    def mine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        size = 0

        def written() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                hashes, counts = _added(parts)
                buckets, starts = np.unique((hashes >> np.uint64(64 - bits)).astype(np.int64), return_index=True)
                cuts = np.r_[starts, len(hashes)].astype(np.int64)
                if short:
                    slots = ((hashes >> np.uint64(64 - bits - _SLOT_BITS)) & np.uint64((1 << _SLOT_BITS) - 1)).astype(np.int64)
                    steps = np.diff(slots, prepend=0)
                    steps[starts] = slots[starts]
                    packs = [pa.array([_packed(part) for part in np.split(values.astype(np.uint32), starts[1:])][: len(buckets)], pa.binary()) for values in (steps, np.minimum(counts, min_count))]
                else:
                    packs = [_slices(hashes, cuts), _slices(counts.astype(np.uint32), cuts)]
                yield pa.RecordBatch.from_arrays([pa.array(buckets), pa.array([lang] * len(buckets), pa.string()), *packs], schema=arrow_schema(_MINED))

        for lang, words, ids, vocabulary in _rows(batches):
            phrases = _Phrases(lang, ids, vocabulary)
            for _ in range(1, length):
                phrases.keep(table.value)
                phrases.lengthen()
            hashes, counts = np.unique(phrases.hashes, return_counts=True)
            frequent = counts >= _support(words, totals.value[lang][0], min_count)
            held.setdefault(lang, []).append((hashes[frequent], counts[frequent]))
            size += len(held[lang][-1][0])
            if size > _HELD:
                held = {lang: [_added(parts)] for lang, parts in held.items()}
                size = sum(len(parts[0][0]) for parts in held.values())
                if size > _HELD // 2:
                    yield from written()
                    held, size = {}, 0
        yield from written()

    return shards.mapInArrow(mine, _MINED)


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Different hashes in order, with their counts added up as far as 32 bits go."""
    hashes, counts = (np.concatenate(arrays) for arrays in zip(*parts))
    order = np.argsort(hashes, kind="stable")
    hashes, counts = hashes[order], counts[order].astype(np.int64)
    starts = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]][: len(hashes)])
    return hashes[starts], np.minimum(np.add.reduceat(counts, starts) if len(starts) else counts, 0xFFFFFFFF)


def _slices(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """The bytes of neighbouring parts of an array, one value each."""
    offsets = pa.py_buffer((cuts * values.itemsize).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, offsets, pa.py_buffer(values)])


def _union(mined: DataFrame, totals, min_count: int, bits: int) -> np.ndarray:
    """The bit table of phrases that may be frequent: local counts and the slack of their language reach ``min_count``.

    ``mined`` is short. A bucket holds the phrases of at most two million words at every size of the input. Bits are put together per segment in Spark; what arrives
    here has a fixed size.
    """
    schema = T.StructType([T.StructField("segment", T.LongType()), T.StructField("places", T.BinaryType())])

    def add(rows: pa.Table) -> pa.Table:
        found = []
        for lang in pc.unique(rows["lang"]).to_pylist():
            of = rows.filter(pc.equal(rows["lang"], lang))
            slots, sums = _added([(np.cumsum(_unpacked(steps, np.uint32)), _unpacked(counts, np.uint32)) for steps, counts in zip(of["hashes"].to_pylist(), of["counts"].to_pylist())])
            found.append(slots[sums + totals.value[lang][1] >= min_count])
        # the table has at most as many bits as bucket and slot together
        places = np.unique((rows["bucket"][0].as_py() << _SLOT_BITS | np.concatenate(found).astype(np.int64)) >> (bits + _SLOT_BITS - _TABLE_BITS))
        if not len(places):
            return pa.table({"segment": pa.array([], pa.int64()), "places": pa.array([], pa.binary())})
        # the leading bits of a bucket name its segment
        return pa.table({"segment": pa.array([int(places[0]) >> _SEGMENT_BITS], pa.int64()), "places": pa.array([(places & ((1 << _SEGMENT_BITS) - 1)).astype(np.uint32).tobytes()])})

    def pack(rows: pa.Table) -> pa.Table:
        flags = np.zeros(1 << _SEGMENT_BITS, np.uint8)
        for part in rows["places"]:
            flags[np.frombuffer(part.as_buffer(), np.uint32)] = 1
        return pa.table({"segment": rows["segment"].slice(0, 1), "places": pa.array([np.packbits(flags, bitorder="little").tobytes()])})

    table = np.zeros(1 << (_TABLE_BITS - 3), np.uint8)
    size = 1 << (_SEGMENT_BITS - 3)
    for row in mined.groupBy("bucket").applyInArrow(add, schema).groupBy("segment").applyInArrow(pack, schema).collect():
        table[row["segment"] * size : (row["segment"] + 1) * size] = np.frombuffer(row["places"], np.uint8)
    return table


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, np.ndarray, list[bytes]]]:
    for batch in batches:
        for i in range(batch.num_rows):
            lang, words, ids, vocabulary = (batch[name][i] for name in ("lang", "words", "ids", "vocabulary"))
            yield lang.as_py(), words.as_py(), _unpacked(ids.as_py(), np.int32) - np.int32(1), vocabulary.as_py().split(b"\n")
            pa.default_memory_pool().release_unused()


def _support(words: int, total: int, min_count: int) -> int:
    return -(-min_count * words // total)


_PHRASES = T.StructType([T.StructField("lang", T.StringType()), T.StructField("words", T.ByteType()), T.StructField("phrase", T.StringType()), T.StructField("n", T.LongType())])


_HANDED = T.StructType([
    T.StructField("bucket", T.LongType()), T.StructField("lang", T.StringType()), T.StructField("phrases", T.BinaryType()), T.StructField("counts", T.BinaryType()),
])


def _counted(shards: DataFrame, table, min_count: int, bits: int) -> DataFrame:
    """``lang, words, phrase, n`` of the candidates with ``min_count`` occurrences, counted in all shards by their words, exactly."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[pa.Table]] = {}
        size = 0

        def written() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                rows = _summed(parts).sort_by([("bucket", "ascending"), ("phrase", "ascending")])
                buckets, starts = np.unique(rows["bucket"].to_numpy(), return_index=True)
                ends = [*starts.tolist(), rows.num_rows][1:]
                parts = [rows.slice(at, end - at) for at, end in zip(starts.tolist(), ends)]
                # no word has a line break
                phrases = [_squeezed("\n".join(part["phrase"].to_pylist()).encode()) for part in parts]
                yield pa.RecordBatch.from_arrays([
                    pa.array(buckets), pa.array([lang] * len(buckets), pa.string()), pa.array(phrases, pa.binary()),
                    pa.array([_packed(part["n"].to_numpy()) for part in parts], pa.binary()),
                ], schema=arrow_schema(_HANDED))

        for lang, found in _occurring(batches, table, bits):
            held.setdefault(lang, []).append(found)
            size += found.num_rows
            if size > _HELD_PHRASES:
                held = {lang: [_summed(parts)] for lang, parts in held.items()}
                size = sum(parts[0].num_rows for parts in held.values())
                if size > _HELD_PHRASES // 2:
                    yield from written()
                    held, size = {}, 0
        yield from written()

    def add(rows: pa.Table) -> pa.Table:
        found = []
        for lang in pc.unique(rows["lang"]).to_pylist():
            of = rows.filter(pc.equal(rows["lang"], lang))
            phrases = [pa.array(_raw(squeezed).decode().split("\n"), pa.string()) for squeezed in of["phrases"].to_pylist()]
            counts = [pa.array(_unpacked(squeezed, np.int64)) for squeezed in of["counts"].to_pylist()]
            summed = pa.table({"phrase": pa.chunked_array(phrases), "n": pa.chunked_array(counts)}).group_by("phrase", use_threads=False).aggregate([("n", "sum")])
            kept = summed.filter(pc.greater_equal(summed["n_sum"], min_count))
            words = pc.add(pc.count_substring(kept["phrase"], " "), 1)
            found.append(pa.table([pa.array([lang] * kept.num_rows, pa.string()), words.cast(pa.int8()), kept["phrase"], kept["n_sum"]], schema=arrow_schema(_PHRASES)))
        return pa.concat_tables(found)

    return shards.mapInArrow(count, _HANDED).groupBy("bucket").applyInArrow(add, _PHRASES)


def _occurring(batches: Iterator[pa.RecordBatch], table, bits: int) -> Iterator[tuple[str, pa.Table]]:
    """``bucket, phrase, n`` of the candidates of each length in each shard."""
    for lang, _, ids, vocabulary in _rows(batches):
        phrases = _Phrases(lang, ids, vocabulary)
        words = np.array([word.decode() for word in vocabulary], object)
        # of each place: the number of the phrase that begins there, among the different phrases of this length
        for length in range(1, LONGEST + 1):
            if length > 1:
                phrases.lengthen()
            phrases.keep(table.value)
            if not len(phrases.starts):
                break
            last = ids[phrases.starts + length - 1].astype(np.int64)
            key = last if length == 1 else number[phrases.starts] << 32 | last
            different, firsts, numbers, counts = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
            texts = words[different] if length == 1 else texts[different >> 32] + " " + words[different & 0xFFFFFFFF]
            number = np.zeros(len(ids), np.int64)
            number[phrases.starts] = numbers
            buckets = (phrases.hashes[firsts] >> np.uint64(64 - bits)).astype(np.int64)
            yield lang, pa.table({"bucket": buckets, "phrase": pa.array(texts.tolist(), pa.string()), "n": counts})


def _summed(parts: list[pa.Table]) -> pa.Table:
    summed = pa.concat_tables(parts).group_by(["bucket", "phrase"], use_threads=False).aggregate([("n", "sum")])
    return summed.select(["bucket", "phrase", "n_sum"]).rename_columns(["bucket", "phrase", "n"])


def frequent_phrases(docs: DataFrame, *, min_count: int = 30, shard_words: int = 1 << 18) -> tuple[DataFrame, DataFrame]:
    """``lang, words, phrase, n`` of every phrase of one to four words with ``min_count`` occurrences, and ``lang, n`` of all words.

    The counts are exact for any ``min_count`` of at least one and any size of shards. Both tables are stored.
    """
    spark = docs.sparkSession
    shards = store(_shards(docs, shard_words))
    totals = settle(shards.groupBy("lang").agg(F.sum("words").alias("n")))
    support = F.ceil(F.lit(min_count).cast("decimal(38,0)") * F.col("words") / F.col("n")).cast("bigint")
    slack = shards.select("lang", "words").join(F.broadcast(totals), "lang").groupBy("lang").agg(F.first("n").alias("n"), F.sum(support - 1).alias("slack"))
    known = {row["lang"]: (row["n"], row["slack"]) for row in slack.collect()}  # two numbers per language
    bits = max(_TABLE_BITS - _SEGMENT_BITS, (sum(n for n, _ in known.values()) >> 21).bit_length())
    shipped = spark.sparkContext.broadcast(known)
    flags, table = np.zeros(1 << (_TABLE_BITS - 3), np.uint8), None
    for length in range(1, LONGEST + 1):
        mined = _mine(shards, length, table, shipped, min_count, bits, short=True)
        flags |= _union(mined, shipped, min_count, bits)  # the hash of a phrase depends on its length, so one table serves all
        if table is not None:
            table.unpersist()
        table = spark.sparkContext.broadcast(flags)
    return store(_counted(shards, table, min_count, bits)), totals


def mine_collocations(docs: DataFrame, *, min_count: int = 30, covered_percent: int = 80, top: int = 2000, shard_words: int = 1 << 18) -> DataFrame:
    """The best collocations of each language: ``lang, rank, phrase, a, l, r, n, score``.

    Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line breaks, and pieces into words at spaces and tabs. Candidates are
    phrases of two to four words with at least ``min_count`` occurrences ``a``. A candidate is cut where its parts, with ``l`` and ``r``
    occurrences, give the lowest score ``floor(2000000 * a / (l + r))``, at equal scores after the fewest words. Candidates inside a longer
    one that has ``covered_percent`` of their occurrences are left out. ``n`` is the number of all words of the language. Each language
    keeps its first ``top`` by score, then ``a``, both descending, then phrase.

    A NULL text is empty, a NULL language is ``und`` and one with texts that say so. Repeated rows count as often as they stand there. Texts
    of any length are used whole, and so are words. An empty table gives no rows. Other columns are not read.
    """
    phrases, totals = frequent_phrases(docs, min_count=min_count, shard_words=shard_words)
    wide = "decimal(38,0)"
    candidates = phrases.where("words > 1").select("lang", "words", "phrase", F.col("n").alias("a"))
    parts = phrases.select("lang", F.col("phrase").alias("part"), F.col("n").alias("n_part"))
    words = F.split("phrase", " ")
    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select("*", F.array_join(F.slice(words, F.lit(1), F.col("k")), " ").alias("first"), F.array_join(F.slice(words, F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("rest"))
    cuts = cuts.join(parts.withColumnsRenamed({"part": "first", "n_part": "l"}), ["lang", "first"]).join(parts.withColumnsRenamed({"part": "rest", "n_part": "r"}), ["lang", "rest"])
    score = F.expr(f"CAST(CAST(a AS {wide}) * 2000000 DIV (CAST(l AS {wide}) + r) AS bigint)")
    lowest = cuts.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    def inside(size: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.col("words") - size + 1), lambda at: F.array_join(F.slice(words, at, size), " "))

    inner = candidates.where("words > 2").select("lang", F.explode(F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), inside))).alias("phrase"), "a")
    longer = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    covered = F.col("longer").isNotNull() & (F.col("longer").cast(wide) * 100 >= F.col("a").cast(wide) * covered_percent)
    kept = lowest.join(longer, ["lang", "phrase"], "left").where(~covered)
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    # each of 64 parts of a language hands on its own best, so that no task ranks a whole language
    parted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    best = kept.withColumn("rank", F.row_number().over(parted)).where(F.col("rank") <= top).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(F.broadcast(totals), "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
