"""Reading and writing tables, and looking at a few of their rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F, types as T

from quillframe.errors import TableError
from quillframe.functions.convert import number_text, whole_text
from quillframe.functions.missing import fold_missing_tokens, fold_nan
from quillframe.functions.names import clean_headers
from quillframe.functions.types import FLOATING, is_moment, quoted
from quillframe.sources.records import quoted_records

_RECORD, _SURPLUS = "_record", "_surplus"
PREVIEW_ROWS = 12  # fixed value: rows of a preview

# Quotes are doubled inside quoted fields, as spreadsheets write them, not escaped by a backslash.
_DIALECT = {"quote": '"', "escape": '"'}

# The types tried for a text column, narrowest first.
_CANDIDATES = {
    "bigint": whole_text,
    "double": number_text,
    "boolean": lambda text: F.when(text.isin("True", "TRUE", "true"), F.lit(True)).when(
        text.isin("False", "FALSE", "false"), F.lit(False)
    ),
}


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | None = None,
    multiline: bool = False,
    encoding: str = "UTF-8",
) -> DataFrame:
    """A delimited file or folder with a header row.

    Headers are cleaned (:func:`quillframe.functions.names.clean_headers`) and missing-value tokens
    become NULL. Without a ``schema`` the types come from one aggregation over the whole file: whole
    numbers, else decimals, else truth values, else text; with a schema that pass only looks for faulty rows. Rows with more
    fields than the header are an error, shorter ones are filled with NULL, and all files must have the same header.
    ``multiline`` allows line breaks in quoted fields. Files are split among tasks either way; with it they are stored once in
    the checkpoint folder, cut into records (:mod:`quillframe.sources.records`). In other encodings than UTF-8 a task then
    reads a whole file. Without it a row with an unclosed quote is an error that names the option.
    """
    options = {**_DIALECT, "multiLine": str(multiline).lower(), "encoding": encoding}
    paths = [path] if isinstance(path, str) else list(path)
    try:
        heading = spark.read.options(**options, header="false").csv(paths).first()
        if heading is None:
            raise TableError("The file is empty.")
        names = clean_headers(str(name).lstrip("﻿") if name is not None else None for name in heading)
        whole, surplus = (next(n for n in (mark, mark + "_") if n not in names) for mark in (_RECORD, _SURPLUS))
        texts = T.StructType([T.StructField(name, T.StringType()) for name in [*names, surplus, whole]])
        parsing = {**options, "columnNameOfCorruptRecord": whole, "columnPruning": "false"}  # a row is judged by all of its fields
        if multiline and encoding.upper().replace("-", "") == "UTF8":
            raw = _parsed(quoted_records(spark, paths), texts, parsing, names, surplus, whole)
        else:
            _require_same_headers(spark, paths, options, heading)
            raw = spark.read.options(**parsing, header="true", enforceSchema="true").schema(texts).csv(paths)
    except AnalysisException as problem:
        raise TableError(f"The table could not be read: {problem}") from problem
    marked = raw.withColumn(whole, _fault(quoted(whole), quoted(surplus), len(names)))
    folded = fold_missing_tokens(marked.select(*[quoted(n) for n in names]))
    checked = fold_missing_tokens(marked.select(*[quoted(n) for n in [*names, whole]]))
    if schema is not None and len(schema) != len(names):
        raise TableError(f"The schema has {len(schema)} columns, the file {len(names)}.")
    types = _checked_types(checked, names, whole, infer=schema is None)
    if schema is not None:
        return _typed(folded.toDF(*schema.names), {f.name: f.dataType.simpleString() for f in schema.fields})
    return _typed(folded, types)


def _parsed(records: DataFrame, texts: T.StructType, options: dict[str, str], names: list[str], surplus: str, whole: str) -> DataFrame:
    """The fields of records, as the reader of files gives them. All first records must be the same."""
    text = F.regexp_replace("record", "\r$", "")
    headings = records.where("heading").select(text.alias("line")).distinct().limit(2).collect()
    if len(headings) > 1:
        raise TableError(f"The files have different headers: {headings[0]['line']!r} and {headings[1]['line']!r}.")
    ddl = ", ".join(f"`{name.replace('`', '``')}` STRING" for name in texts.names)
    parsed = records.where(~F.col("heading")).select(text.alias("text")).select("text", F.from_csv("text", ddl, options).alias("row"))
    fields = [F.col("row").getField(name).alias(name) for name in [*names, surplus]]
    return parsed.select(*fields, F.when(F.col("row").getField(whole).isNotNull(), F.col("text")).alias(whole))


def _require_same_headers(spark: SparkSession, paths: list[str], options: dict[str, str], heading: Row) -> None:
    """Columns are matched by place, so every file must begin with the same line."""
    lines = spark.read.option("wholetext", "false").text(paths).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"))
    firsts = lines.where("at = 0").groupBy("file").agg(F.first("value").alias("line"))
    others = firsts.select(F.regexp_replace("line", "^\ufeff", "").alias("line")).distinct().limit(3).collect()
    if len(others) > 1:
        raise TableError(f"The files have different headers: {others[0]['line']!r} and {others[1]['line']!r}.")


def _fault(record: Column, surplus: Column, width: int) -> Column:
    """What is wrong with a row: more fields than names, or a quote that is not closed.

    Rows are read with one field more than there are names. Spark hands the whole record on unless just that number of fields is there, so
    that no record means one too many. Otherwise the commas outside quotes are counted, as surplus fields can be empty.
    """
    quotes = F.length(record) - F.length(F.replace(record, F.lit('"'), F.lit("")))
    bare = F.when(quotes > 0, F.regexp_replace(record, '"[^"]*+"', "")).otherwise(record)
    commas = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit("")))
    return F.when(quotes % 2 == 1, "quote").when(record.isNull() | surplus.isNotNull() | (commas >= width), "fields")


def _checked_types(texts: DataFrame, names: list[str], whole: str, infer: bool) -> dict[str, str]:
    """The types of the columns, and an error for faulty rows, from one aggregation."""
    wrong = [F.count_if(quoted(whole) == kind).alias(kind) for kind in ("quote", "fields")]
    seen = texts.agg(*wrong, *(_type_counts(names) if infer else [])).first()
    if seen["quote"]:
        raise TableError(f"{seen['quote']} rows have a quote that is not closed; for line breaks in quoted fields pass multiline=True.")
    if seen["fields"]:
        raise TableError(f"{seen['fields']} rows have more fields than the header.")
    return _narrowest(names, seen[2:]) if infer else {}


def infer_types(texts: DataFrame) -> dict[str, str]:
    """The narrowest of bigint, double, boolean and string that holds every present text of each column.

    A column without any text is a double, as an all-missing column is a numeric one.
    """
    return _narrowest(texts.columns, texts.agg(*_type_counts(texts.columns)).first())


def _type_counts(names: Sequence[str]) -> list[Column]:
    return [
        F.struct(
            F.count(quoted(name)).alias("present"),
            *[F.count(parse(quoted(name))).alias(kind) for kind, parse in _CANDIDATES.items()],
        ).alias(f"c{i}")
        for i, name in enumerate(names)
    ]


def _narrowest(names: Sequence[str], counts: Sequence[Row]) -> dict[str, str]:
    chosen = {}
    for name, seen in zip(names, counts):
        fits = [kind for kind in _CANDIDATES if seen[kind] == seen["present"]]
        chosen[name] = "double" if not seen["present"] else fits[0] if fits else "string"
    return chosen


def _typed(texts: DataFrame, types: dict[str, str]) -> DataFrame:
    def cast(name: str, kind: str) -> Column:
        text = quoted(name)
        return _CANDIDATES[kind](text) if kind in _CANDIDATES else text.try_cast(kind)

    return texts.select(*[cast(name, types[name]).alias(name) for name in texts.columns])


def read_parquet(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """A Parquet table with clean headers; NaN becomes NULL."""
    paths = [path] if isinstance(path, str) else list(path)
    try:
        df = spark.read.parquet(*paths)
    except AnalysisException as problem:
        raise TableError(f"The table could not be read: {problem}") from problem
    names = clean_headers(df.columns)
    return fold_nan(df if names == df.columns else df.toDF(*names))


def with_row_key(df: DataFrame, name: str = "_row_key") -> DataFrame:
    """Add a row key (file and position in it) to a table just read from Parquet, without a shuffle.

    The key is the same on every read, so hash draws on a table without a key column of its own are
    repeatable, and copies of one row are still told apart.
    """
    place = F.concat_ws("#", F.col("_metadata.file_path"), F.col("_metadata.row_index").cast("string"))
    return df.select("*", place.alias(name))


def write_csv(df: DataFrame, path: str) -> None:
    """A folder of CSV files with header rows, one per partition.

    Gaps are written as empty fields, and times by their text, which keeps the microseconds.
    """
    texts = [
        quoted(f.name).cast("string").alias(f.name) if is_moment(f.dataType) else quoted(f.name) for f in df.schema.fields
    ]
    df.select(*texts).write.options(**_DIALECT, header="true", nullValue="", emptyValue='""').csv(path)


def head(df: DataFrame, n: int, order_by: Sequence[str] = ()) -> DataFrame:
    """The first ``n`` rows by the given columns; any ``n`` rows without them."""
    return (df.orderBy(*[quoted(name) for name in order_by]) if order_by else df).limit(n)


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def preview(df: DataFrame, order_by: Sequence[str] = (), n: int = PREVIEW_ROWS) -> DataFrame:
    """The first rows with JSON-safe values: NaN and infinities as NULL, dates and times in ISO 8601."""

    def safe(field: T.StructField) -> Column:
        value = quoted(field.name)
        if isinstance(field.dataType, FLOATING):
            finite = ~(F.isnan(value) | (F.abs(value) == F.lit(float("inf"))))
            return F.when(finite, value).alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return F.date_format(value, "yyyy-MM-dd").alias(field.name)
        if is_moment(field.dataType):
            return F.regexp_replace(value.cast("string"), " ", "T").alias(field.name)
        return value

    first = head(df, n, order_by)
    return first.select(*[safe(field) for field in df.schema.fields])


def preview_json(df: DataFrame, order_by: Sequence[str] = (), n: int = PREVIEW_ROWS) -> DataFrame:
    """:func:`preview` as one JSON text per row, in column ``record``; gaps are kept as nulls."""
    shown = preview(df, order_by, n)
    return shown.select(F.to_json(F.struct(*[quoted(c) for c in shown.columns]), {"ignoreNullFields": "false"}).alias("record"))


def require_content(df: DataFrame) -> DataFrame:
    """The table itself, if it has at least one column and one row."""
    if not df.columns:
        raise TableError("The table has no columns.")
    if df.isEmpty():
        raise TableError("The table has no rows.")
    return df
