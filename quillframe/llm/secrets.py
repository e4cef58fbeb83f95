"""Secret scans with a recursive decoding worklist.

A text is scanned as it is. Then everything in it that looks encoded is unwrapped: percent escapes, backslash escapes of
Unicode, base64 runs, wrapped to lines or not, and compressed data inside of these. Each layer keeps, for each of its characters, the
span of the text that it came from; it is scanned in turn and put on the worklist, until nothing new comes out. A layer that was
already seen at the same place is not entered again, which ends cycles. Spans found in a layer are mapped to the text.

Compressed data is unpacked as a stream, whatever its size, and scanned in windows of :data:`WINDOW` bytes that overlap by
:data:`OVERLAP`. Only what is longer than the overlap and lies across the end of a window is seen in parts; the shortest secrets of
each kind are far below that, and long runs of spaces, which an assignment may hold, are shortened first.
"""

from __future__ import annotations

import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from quillframe.llm.common import arrow_schema, column, fresh, slices

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
# The shortest assignment has 12 bytes, so shorter runs of base64 than 16 letters hold no secret.
LONG = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}")
WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{4,}(?:\r?\n[\x20\t]*[A-Za-z0-9+/_-]{2,})+={0,2}")
# Beginnings of gzip, bzip2, xz and Zstandard data in base64, and of zlib data after a slash.
PACKED = re.compile(r"H4sI|Qlpo|/Td6WFo|KLUv/|(?<=/)e[AFJN]")
PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2})+")
ONE_ESCAPE = re.compile(r"\\(?:u([0-9A-Fa-f]{4})|U([0-9A-Fa-f]{8})|x([0-9A-Fa-f]{2}))")
WINDOW, OVERLAP, CHUNK = 8 << 20, 1 << 16, 1 << 20
_SPACES = re.compile(rb"\x20{65,}")
MASK = "[REDACTED]"


@dataclass
class Layer:
    """A decoded text and, for each character, the span of the original that it stands for: arrays, neither of which ever
    falls, or one number for a layer that stands for one span as a whole."""

    text: str
    starts: np.ndarray | int
    ends: np.ndarray | int

    def low(self, places):
        return self.starts[places] if isinstance(self.starts, np.ndarray) else np.full(np.shape(places), self.starts)

    def high(self, places):
        return self.ends[places] if isinstance(self.ends, np.ndarray) else np.full(np.shape(places), self.ends)

    def span(self, start: int, end: int) -> tuple[int, int]:
        return int(self.low(start)), int(self.high(end - 1))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``start, kind, end`` of the matches in one text, leftmost and non-overlapping for each kind."""
    found = []
    lowered = text.lower()
    if any(name in lowered for name in NAMES):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _packing(data: bytes) -> str | None:
    """How data is compressed, by its first bytes."""
    if data[:2] == b"\x1f\x8b" or (data[:1] == b"\x78" and len(data) > 1 and (data[0] << 8 | data[1]) % 31 == 0):
        return "zlib"
    for kind, mark in (("bz2", b"BZh"), ("xz", b"\xfd7zXZ\x00"), ("zstd", b"\x28\xb5\x2f\xfd")):
        if data.startswith(mark):
            return kind
    return None


class _Source:
    """Chunks of bytes as a file to read from, of which nothing before is kept."""

    def __init__(self, chunks: Iterator[bytes]) -> None:
        self._chunks, self._rest = chunks, b""

    def read(self, size: int = CHUNK) -> bytes:
        while not self._rest:
            if (chunk := next(self._chunks, None)) is None:
                return b""
            self._rest = chunk
        found, self._rest = self._rest[:size], self._rest[size:]
        return found


def _inflated(kind: str, chunks: Iterator[bytes]) -> Iterator[bytes]:
    """Compressed chunks unpacked, in pieces of at most ``CHUNK`` bytes, as far as they are not broken."""
    source = _Source(chunks)
    try:
        if kind == "zstd":
            import zstandard

            with zstandard.ZstdDecompressor().stream_reader(source, read_across_frames=True) as reader:
                while piece := reader.read(CHUNK):
                    yield piece
            return
        data = source.read()
        while data:  # one member of the stream after the other
            work = {"zlib": lambda: zlib.decompressobj(47), "bz2": bz2.BZ2Decompressor, "xz": lzma.LZMADecompressor}[kind]()
            while not work.eof:
                piece = work.decompress(data, CHUNK)
                if piece:
                    yield piece
                data = work.unconsumed_tail if kind == "zlib" else b""
                if not data and not work.eof and (kind == "zlib" or work.needs_input):
                    data = source.read()
                    if not data and not piece:
                        return
            data = work.unused_data or source.read()
    except (zlib.error, OSError, lzma.LZMAError, EOFError, ValueError):
        return
    except Exception as problem:  # zstandard's own error class
        if type(problem).__name__ != "ZstdError":
            raise


def _text(data: bytes) -> str:
    """Bytes as text: UTF-8 or, where they are none, one letter for each byte."""
    try:
        return data.decode("utf-8")
    except UnicodeDecodeError:
        return data.decode("latin-1")


def _texts(data: bytes) -> Iterator[str]:
    """The text of bytes, unpacked as often as they are compressed: one, or windows of it one after the other."""
    if _packing(data) is None:
        if data:
            yield _text(data)
        return
    seen, chunks = set(), iter([data])
    first = data
    while (kind := _packing(first)) is not None and (digest := hashlib.sha256(first).digest()) not in seen:
        seen.add(digest)  # data that unpacks to itself ends here
        chunks = _inflated(kind, chunks)
        first = next(chunks, b"")
        chunks = _chained(first, chunks)
    held = bytearray()
    for chunk in chunks:
        held += chunk
        if len(held) >= WINDOW:
            short = _SPACES.sub(b" " * 64, bytes(held))
            yield _text(short)
            held = bytearray(short[-OVERLAP:])
    if held:
        yield _text(_SPACES.sub(b" " * 64, bytes(held)))


def _chained(first: bytes, rest: Iterator[bytes]) -> Iterator[bytes]:
    yield first
    yield from rest


def _base64(run: str) -> bytes:
    """What letters of a base64 alphabet stand for; a last letter that holds no whole byte is left out."""
    body = run.rstrip("=").replace("-", "+").replace("_", "/")
    body = body[: len(body) - (len(body) % 4 == 1)]
    return binascii.a2b_base64(body + "=" * (-len(body) % 4))


def _runs(run: str) -> Iterator[str]:
    """What a run of base64 letters may hold. Base64 can begin behind other letters of its alphabet, such as a path: text in it
    shows up under one of four shifts, compressed data at its first letters."""
    yield run
    if any(mark in run for mark in "/-_+"):
        yield from (run[shift:] for shift in (1, 2, 3))
        yield from (run[match.start() :] for match in PACKED.finditer(run, 1))


def _percent(run: str) -> tuple[str, np.ndarray, np.ndarray] | None:
    """The text of percent escapes, with the place in the run where each character begins and ends. Compressed bytes are none."""
    data = bytes.fromhex(run.replace("%", ""))
    if _packing(data):
        return None
    text = _text(data)
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    sizes = np.ones(len(codes), np.int64) if len(codes) == len(data) else 1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + (codes >= 0x10000)
    ends = 3 * np.cumsum(sizes)
    return text, ends - 3 * sizes, ends


def _escapes(run: str) -> tuple[str, np.ndarray, np.ndarray]:
    """The text of backslash escapes. Two halves of a UTF-16 pair are one character."""
    codes, starts, ends = [], [], []
    for match in ONE_ESCAPE.finditer(run):
        code = int(match.group(match.lastindex), 16)
        if 0xDC00 <= code < 0xE000 and codes and 0xD800 <= codes[-1] < 0xDC00:
            codes[-1] = 0x10000 + (codes[-1] - 0xD800 << 10) + (code - 0xDC00)
            ends[-1] = match.end()
            continue
        codes.append(code)
        starts.append(match.start())
        ends.append(match.end())
    text = "".join(chr(code) if code < 0x110000 and not 0xD800 <= code < 0xE000 else "\ufffd" for code in codes)
    return text, np.array(starts), np.array(ends)


def _replaced(layer: Layer, pattern: re.Pattern, decode) -> Layer | None:
    """The layer with every run that the pattern finds put in its decoded form."""
    parts, starts, ends, at = [], [], [], 0
    every = np.arange(len(layer.text))
    for match in pattern.finditer(layer.text):
        decoded = decode(match.group())
        if decoded is None:
            continue
        a, b = match.span()
        inner, first, last = decoded
        parts += [layer.text[at:a], inner]
        starts += [layer.low(every[at:a]), layer.low(a + first)]
        ends += [layer.high(every[at:a]), layer.high(a + last - 1)]
        at = b
    if not parts:
        return None
    rest = every[at:]
    return Layer("".join([*parts, layer.text[at:]]), np.concatenate([*starts, layer.low(rest)]), np.concatenate([*ends, layer.high(rest)]))


def unwrap(layer: Layer) -> Iterator[Layer]:
    """The layers right below one."""
    text = layer.text
    if "%" in text:
        if inner := _replaced(layer, PERCENT, _percent):
            yield inner
        for match in PERCENT.finditer(text):
            data = bytes.fromhex(match.group().replace("%", ""))
            if _packing(data):
                yield from (Layer(inner, *layer.span(*match.span())) for inner in _texts(data))
    if "\\" in text and (inner := _replaced(layer, ESCAPE, _escapes)):
        yield inner
    for pattern in (LONG, WRAPPED):
        for match in pattern.finditer(text):
            run = match.group() if pattern is LONG else re.sub(r"\s", "", match.group())
            if len(run) >= 16:
                span = layer.span(*match.span())
                yield from (Layer(inner, *span) for shifted in _runs(run) for inner in _texts(_base64(shifted)))


def all_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """The spans of the text itself, and all spans with those of its decoded layers."""
    base = base_spans(text)
    found, seen = set(base), {_place(text, 0, len(text))}
    every = np.arange(len(text) + 1)
    work = [unwrap(Layer(text, every[:-1], every[1:]))]
    while work:
        if (layer := next(work[-1], None)) is None:
            work.pop()
            continue
        if not layer.text:
            continue
        low, high = layer.span(0, len(layer.text))
        place = _place(layer.text, low, high)
        if place in seen:
            continue
        seen.add(place)
        for start, kind, end in base_spans(layer.text):
            first, last = layer.span(start, end)
            found.add((first, kind, last))
        work.append(unwrap(layer))  # layers come one by one, so that windows of one that is unpacked are never held together
    return base, sorted(found)


def _place(text: str, low: int, high: int) -> tuple[bytes, int, int]:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest(), low, high


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def redact(text: str, spans: list[tuple[int, int, int]], mask: str = MASK) -> str:
    """The text with all that the spans cover replaced, overlapping spans by one mask."""
    parts, at, covered = [], 0, 0
    for start, _, end in spans:
        if start >= covered:
            parts += [text[at:start], mask]
        at = covered = max(covered, end)
    return "".join([*parts, text[at:]])


def find_secrets(docs: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_decoded``, one row per row of ``docs``.

    The counts and ``base_sha256`` are of the text as it stands; ``spans`` has those of decoded layers as well, and
    ``n_decoded`` says how many these add. A NULL text is empty. Texts of any length are scanned whole, with time in proportion to
    their layers. Repeated rows and rows with a NULL or repeated ``doc_id`` stay rows of their own. An empty table gives no rows. Other
    columns are not read, whatever their names.
    """
    schema = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType), *(T.StructField(f"n_{kind}", T.LongType()) for kind in KINDS),
        T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType()), T.StructField("n_decoded", T.LongType()),
    ])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = arrow_schema(schema)
        for batch in slices(batches):
            rows = [all_spans(text or "") for text in batch["text"].to_pylist()]
            counts = [[sum(1 for _, k, _ in base if k == kind) for base, _ in rows] for kind in range(len(KINDS))]
            made = [
                *counts, [hashlib.sha256(written(base).encode()).hexdigest() for base, _ in rows], [written(spans) for _, spans in rows], [len(spans) - len(base) for base, spans in rows],
            ]
            yield pa.RecordBatch.from_arrays([batch["doc_id"].cast(target.field(0).type), *(pa.array(m, f.type) for m, f in zip(made, list(target)[1:]))], schema=target)

    return docs.select(column(docs, "doc_id").alias("doc_id"), column(docs, "text", "string").alias("text")).mapInArrow(scan, schema)


def redact_secrets(docs: DataFrame, mask: str = MASK) -> DataFrame:
    """``docs`` with all secrets in ``text`` masked, and ``n_chars``, where there is one, counted anew. Rows and other columns stay as they are.

    A NULL text stays NULL.
    """
    made = fresh(docs, "safe_text")
    schema = T.StructType([*docs.schema.fields, T.StructField(made, T.StringType())])

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = arrow_schema(schema)
        for batch in slices(batches):
            texts = []  # of the rows that change; the others go through as they are
            for text in batch["text"].to_pylist():
                spans = all_spans(text or "")[1]
                texts.append(redact(text, spans, mask) if spans else None)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], schema=target)

    cleaned = docs.mapInArrow(clean, schema)
    changed = F.col(made).isNotNull()
    kinds = {f.name: f.dataType for f in docs.schema.fields}
    again = {
        "text": F.coalesce(made, "text"),
        "n_chars": F.when(changed, F.length(made).cast(kinds["n_chars"])).otherwise(F.col("n_chars")) if "n_chars" in kinds else None,
    }
    return cleaned.select(*[again[c].alias(c) if c in again else F.col(f"`{c}`") for c in docs.columns])
